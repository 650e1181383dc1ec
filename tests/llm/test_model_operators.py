"""Language-model scores, nearest neighbours and WARC archives against plain versions."""

import base64
import collections
import functools
import hashlib
import io
import math
import re
import zipfile
import zlib

import numpy as np
import pytest

from candlewick.llm import forest, lm, warc


def test_language_model(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(None, "the the"), (100000, None), (100001, ""), (3, "the of"), (3, "the of"), (100002, "w" * 70000), (100003, "é x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as c", "2 as score", "3 as row")
    found = sorted(map(tuple, lm.score(docs).collect()), key=str)
    fold = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"] for _, t in rows]
    count = collections.Counter(w for (d, _), own in zip(rows, tokens) if not fold(d) for w in own)
    n, v = sum(count.values()), len(count)
    want = [
        (d, fold(d), len(own), sum(count[w] > 0 for w in own), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own))
        for (d, _), own in zip(rows, tokens)
    ]
    for have, expected in zip(found, sorted(want, key=str)):
        assert have[:5] == expected[:5] and have[5] == pytest.approx(expected[5])
    held = [r for r in found if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # better than the unigram base on texts it has not seen
    assert lm.score(docs.limit(0)).count() == 0


def test_model_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    scores = []
    for n in (1, 64):
        held = [r for r in lm.score(docs.repartition(n)).where("held_out").collect()]
        scores.append({r.doc_id: r.score for r in held})
        gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
        assert gain > 0.1  # log10 per token, over the unigram base
    assert scores[0].keys() == scores[1].keys() and all(scores[0][d] == pytest.approx(s, rel=1e-4) for d, s in scores[1].items())


def test_scores_equal_a_sum_token_by_token(spark):
    words = [f"w{i}" for i in range(30)] + ["é", "Aa", "x" * 70]
    rng = np.random.default_rng(13)
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 40)))) for i in range(60)] + [(None, None), (7, "w1 w1 unseen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    taught = docs.where(~lm.held_out(docs["doc_id"]))
    share = spark.sparkContext.broadcast
    counts = {r.word: r.c for r in lm.word_counts(taught).collect()}
    lex = lm.lexicon(lm.word_counts(taught), taught.count())
    p = lm.train(taught, share(lex), share(lm.first_parameters(lex)))
    found = collections.Counter({(r.doc_id, round(r.score, 3)): 1 for r in lm.score(docs).collect()})
    want = collections.Counter()
    for d, text in rows:
        tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]
        near = far = lm.END_ID
        total = 0.0
        for w in tokens:
            listed = None if w is None else lex.index.get(w.encode())
            output = lm.END_ID if w is None else int(lex.output[listed]) if listed is not None else lm.class_of(w.encode())
            score = (p.near[near].astype(float) + p.far[far]) @ p.target.T.astype(float) + p.bias
            total += (score[output] - np.log(np.exp(score - score.max()).sum()) - score.max()) / math.log(10)
            if output < lm.CLASSES:  # its share of the class, by counts plus one
                total += math.log10((counts.get(w, 0) + 1) / (lex.class_total[output] + 1))
            near, far = output, near
        want[d, round(total, 3)] = 1
    close = lambda a, b: a[0] == b[0] and abs(a[1] - b[1]) < 0.01
    assert len(found) == len(want) and all(any(close(a, b) for b in want) for a in found)


def test_learners_follow_the_corpus():
    assert [lm.shards(n) for n in (0, 1, lm.SHARD_TOKENS, lm.SHARD_TOKENS + 1)] == [1, 1, 1, 2]
    assert lm.shards(10**15) == lm.SHARDS
    parts = list(lm._gathered(iter([np.arange(10), np.arange(lm._BLOCK + 5), np.arange(3)])))
    assert [len(t) for own in parts for t in own] == [10, lm._BLOCK, 5, 3]


def test_probabilities_of_all_tokens_add_up_to_one(spark):
    texts = ["a b a c", "a b", "b c d e f g"] * 5
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    known = lm.lexicon(lm.word_counts(docs), docs.count())
    share = spark.sparkContext.broadcast
    p = lm.train(docs, share(known), share(lm.first_parameters(known)))
    z = lm.normalisers(spark, share(p))
    a, b = 130, lm.END_ID
    outputs = np.exp((p.near[a] + p.far[b]) @ p.target.T + p.bias - z[a, b])
    assert outputs.sum() == pytest.approx(1, abs=1e-4)
    # every class: its words by counts plus one, and one unknown word
    counts = {r.word.encode(): r.c for r in lm.word_counts(docs).collect()}
    listed = {w for w, i in known.index.items() if known.output[i] > lm.END_ID}
    assert listed == set(counts)
    assert known.class_total.tolist() == [0] * lm.CLASSES


def test_class_shares_cover_unlisted_words(spark, monkeypatch):
    monkeypatch.setattr(lm, "OUTPUTS", lm.CLASSES + 3)
    docs = spark.createDataFrame([(1, "aa aa aa bb bb cc dd x é")], "doc_id long, text string")
    counts = lm.word_counts(docs)
    known = lm.lexicon(counts, 1)
    want = np.zeros(lm.CLASSES)
    for word, c in (("cc", 1), ("dd", 1), ("x", 1), ("é", 1)):
        want[lm.class_of(word.encode())] += c + 1
    assert known.class_total.tolist() == want.tolist() and known.tokens == 10 and known.words == 7


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as block", "2 as rank")


def brute(rows, every, best):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in usable:
        if q % every == 0:
            scored = sorted((-functools.reduce(lambda s, ab: s + ab[0] * ab[1], zip(x.tolist(), y.tolist()), 0.0), i) for i, y in usable if i != q)
            out[q] = [(i, -s) for s, i in scored[:best]]
    return out


def test_nearest_small_table_is_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(i, [1.0] * 8) for i in range(300, 360)]
    rows += [(400, None), (401, [0.0] * 8), (420, [float("nan")] + [1.0] * 7), (None, [1.0] * 8), (440, [None] + [1.0] * 7), (460, [float("inf")] * 8)]
    found = collections.defaultdict(list)
    for r in sorted(forest.nearest(vectors(spark, rows), block_rows=100).collect(), key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    assert found == brute(rows, 20, 20)
    twice = forest.nearest(vectors(spark, rows[:5] + rows[:2])).collect()
    assert sorted((r.rank, r.vec_id) for r in twice) == [(i + 1, v) for i, v in enumerate([v for v, _ in brute(rows[:5] + rows[1:2], 20, 20)[0]])]
    few = vectors(spark, rows[:5])
    assert [(r.query_id, r.vec_id) for r in forest.nearest(few).collect()] and forest.nearest(few).count() == 4
    assert forest.nearest(few.limit(0)).count() == 0


def test_nearest_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want = brute(rows[:2000], 100, 20)
    made = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = collections.defaultdict(set)
    for r in forest.nearest(made, every=100).collect():
        found[r.query_id].add(r.vec_id)
    assert np.mean([len({i for i, _ in top} & found[q]) / 20 for q, top in want.items()]) >= 0.9


def test_prefix_classes_are_whole():
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.normal(size=(500, 8)), np.ones((400, 8))])
    made = forest.Forest(np.arange(900), data, trees=4, share=0.0, least=50)
    (_, ids, _), = made.search(np.array([899]), np.ones((1, 8)), 1000)
    assert set(range(500, 899)) <= set(ids.tolist())


def test_vectors_of_two_lengths(spark):
    with pytest.raises(Exception, match="differ in length"):
        forest.nearest(vectors(spark, [(0, [1.0]), (1, [1.0, 2.0])])).count()


PAGES = "page_id long, url string, html string"


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_archives_round_trip(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i % 40} é</p>" * (i % 7)) for i in range(200)]
    rows += [(900, None, None), (901, "http://x/a b\r\nX: y", ""), (None, "u", "<p>none</p>"), (None, "u", "<p>none</p>"), (902, "u", "x" * 300000)]
    rows += [(7, "u", "twice"), (7, "u", "twice"), (8, "u", "twice"), (None, "u", "twice")]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'z' as sha1", "1 as smallest")
    found = sorted(map(tuple, warc.round_trip(pages).collect()), key=str)
    least = {}
    for page, _, html in rows:
        if page is not None:
            least[html or ""] = min(page, least.get(html or "", page))
    want = []
    for page, _, html in rows:
        data, first = (html or "").encode(), least.get(html or "")
        revisit = first is not None and page != first
        want.append((page, len(data), sha(data), "revisit" if revisit else "response", first if revisit else None))
    assert found == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_several_archives(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 30) for i in range(50)], PAGES).coalesce(1)
    folder = warc.new_folder(spark, "test-warc")
    archives = warc.write(pages, folder, archive_bytes=2000)
    assert archives.count() > 5
    ranges = warc.record_ranges(archives, folder)
    assert sorted(r.page_id for r in warc.read(ranges.orderBy("length"), folder).collect()) == list(range(50))


def reader(data):
    return (lambda at, n: data[at : at + n]), len(data)


def archive(comment=b"", method=zipfile.ZIP_STORED, wide=False):
    out, record = io.BytesIO(), warc.record(3, "u", b"payload", sha(b"payload"), None)
    with zipfile.ZipFile(out, "w", method) as made:
        made.writestr("readme.txt", "x" * 100, zipfile.ZIP_DEFLATED)
        with made.open("archive/data.warc", "w", force_zip64=wide) as member:
            member.write(record)
        made.writestr("indexes/index.cdx", f" CDX page offset length archive/data.warc\n3 0 {len(record)}\n")
        made.comment = comment
    return out.getvalue(), record


@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 in a comment", b"c" * 65535])
@pytest.mark.parametrize("wide", [False, True])
def test_directories(comment, wide):
    data, record = archive(comment, wide=wide)
    (member, at, length), = warc.locate(*reader(data))
    assert member == "archive/data.warc" and data[at : at + length] == record


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)  # every size and offset goes to 64-bit fields
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data, record = archive(wide=True)
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    (_, at, length), = warc.locate(*reader(data))
    assert warc.parse(data[at : at + length])["page_id"] == 3


def test_archives_that_cannot_be_read():
    with pytest.raises(ValueError, match="compressed"):
        list(warc.locate(*reader(archive(method=zipfile.ZIP_DEFLATED)[0])))
    with pytest.raises(ValueError, match="end record"):
        list(warc.locate(*reader(b"no archive")))
    broken = bytearray(archive()[1])
    broken[-6] ^= 1
    with pytest.raises(ValueError, match="digest"):
        warc.parse(bytes(broken))
