"""BPE, token records and token counts against the tokenizer library."""

import hashlib
import json
import os
import random
import shutil
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.llm import bpe, pieces, queries, records, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
CONTENT = open(PATH, "rb").read()
DOCS = "doc_id long, text string, source string, lang string"
HARD = [None, "", " ", "\n\n x", "it's  we'll ''s 's<|endoftext|>'re", "<|endof", "a" * 5000, "日本 é 　x", "1 22  333\t\n", "naïve 😀😀"]


def flat(texts):
    data = [t.encode() for t in texts]
    return b"".join(data), np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def check(texts):
    for encoder in (bpe._encoder(CONTENT), pieces.library_encoder(CONTENT)):
        ids, at = encoder(*flat(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [expected(t) for t in texts]
    data, at = bpe._table(CONTENT).decode(ids, at)
    assert [data[a:b].tobytes().decode() for a, b in zip(at, at[1:])] == texts


def test_mixed_pieces_equal_the_library():
    random.seed(3)
    parts = [" ", "\n", "a", "'s", "'", "ll", "é", "12", "!!", "<|endoftext|>", "　", "\x85", "日", "😀", "the", "aaaa"]
    check(["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(3000)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_any_text_equals_the_library(texts):
    check(texts)


def test_every_kind_of_character_is_cut_as_by_the_library():
    points = [*range(0x3000), *range(0x3000, 0xD800, 41), *range(0xE000, 0x20000, 59)]
    check([f"a {chr(c)}b1{chr(c)} {chr(c)}" for c in points if not 0xD800 <= c < 0xE000])


def test_clearing_the_memory_changes_nothing():
    encoder = bpe._encoder(CONTENT)
    encoder.clear()
    encoder.LIMIT = 3
    try:
        check(["one two three", "four five one", "one two"])
    finally:
        del encoder.LIMIT


def test_forgetting_rare_pieces_changes_nothing():
    encoder = pieces.LibraryEncoder(CONTENT)
    encoder.LIMIT = 40
    rng = random.Random(2)
    common = [f" word{i}" for i in range(10)]
    for _ in range(30):
        texts = ["".join(rng.choices(common, k=8)) + f" rare{rng.random()}" for _ in range(3)]
        ids, at = encoder(*flat(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [expected(t) for t in texts]
    assert len(encoder.index) < 100 and b" word" in encoder.index


def test_new_pieces_go_through_the_fast_form_of_the_library():
    class Fast:
        def __init__(self, library):
            self.encode_batch_fast, self.cut = library.encode_batch_fast, library.pre_tokenizer

    encoder = pieces.LibraryEncoder(CONTENT)
    encoder.library = Fast(encoder.library)
    texts = ["".join(random.Random(i).choices("ab é日😀'1\n", k=3000)) for i in range(5)] + ["", "<|endoftext|>x", "x" * 700]
    ids, at = encoder(*flat(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [expected(t) for t in texts]
    assert not json.loads(encoder.library.cut.__getstate__())["use_regex"]


@pytest.mark.parametrize("unknown", ["<unk>", None])
def test_a_vocabulary_without_some_bytes(unknown):
    spec = json.loads(CONTENT)
    vocab = {c: i for i, c in enumerate(["a", "b", "ab", "Ġ", "Ġa", *([unknown] if unknown else [])])}
    spec["model"] |= {"vocab": vocab, "merges": [["a", "b"], ["Ġ", "a"]], "unk_token": unknown}
    spec["added_tokens"] = []
    content = json.dumps(spec).encode()
    library = tokenizers.Tokenizer.from_buffer(content)
    texts = ["ab cab a", "c", "dd ab", "", "ab"]
    ids, at = pieces.LibraryEncoder(content)(*flat(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [library.encode(t).ids for t in texts]


def test_digests(spark):
    rows = [(i, t, "s", "en") for i, t in enumerate(HARD)] + [(1, "again", "s", "en"), (1, "again", "s", "en"), (None, "x", None, None)]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "'clash' as ids", "0 as n_tokens")
    found = sorted(map(tuple, bpe.token_digests(df, PATH).collect()), key=str)
    want = []
    for doc, text, *_ in rows:
        ids = np.array(expected(text), "<u4")
        decoded = LIBRARY.decode(ids.tolist(), skip_special_tokens=False)
        want.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert found == sorted(want, key=str)
    assert bpe.token_digests(df.limit(0), PATH).count() == 0


def test_decoding_bytes_that_are_no_text(spark):
    df = spark.createDataFrame([(bytearray(np.array([160, 50256], "<u4").tobytes()),), (None,)], "ids binary")
    ids = [160, 50256]
    assert [r.decoded for r in bpe.decode(df, PATH).collect()] == [LIBRARY.decode(ids, skip_special_tokens=False), ""]


def test_checksums_of_known_values():
    for data, crc in ((b"123456789", 0xE3069283), (bytes(32), 0x8A9136AA), (b"\xff" * 32, 0x62A8AB43), (b"", 0), (b"a", 0xC1D04330)):
        assert records.crc32c(np.frombuffer(data, np.uint8), np.array([0, len(data)])).tolist() == [crc]


def plain_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums_equal_bit_by_bit_ones():
    rng = np.random.default_rng(5)
    lengths = [*range(12), 63, 64, 65, 127, 128, 129, 192, 193, 0, 256, 257, 449, 1000, 3, 4097, 0, 9000, 1]
    data = rng.integers(0, 256, sum(lengths), dtype=np.uint8)
    data[4000:4300] = 0
    at = np.concatenate([[0], np.cumsum(lengths)])
    assert records.crc32c(data, at).tolist() == [plain_crc32c(data[a:b].tobytes()) for a, b in zip(at, at[1:])]
    inner = at[5:]  # offsets need not begin at 0
    assert records.crc32c(data, inner).tolist() == records.crc32c(data, at).tolist()[5:]


def test_checksum_of_a_long_record_costs_what_its_bytes_cost():
    data = np.random.default_rng(6).integers(0, 256, 1 << 20, dtype=np.uint8)
    best = []
    for at in (np.array([0, 1 << 20]), np.arange(0, (1 << 20) + 1, 1 << 12)):
        times = []
        for _ in range(5):
            began = time.thread_time()
            records.crc32c(data, at)
            times.append(time.thread_time() - began)
        best.append(min(times))
    assert best[0] < 3 * best[1]


def test_checksums_side_by_side_equal_one_by_one():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    at = np.sort(np.concatenate([[0, 5000], rng.integers(0, 5000, 40)]))
    one = [int(records.crc32c(data[a:b], np.array([0, b - a]))[0]) for a, b in zip(at, at[1:])]
    assert records.crc32c(data, at).tolist() == one


def test_a_damaged_record_is_noticed():
    framed = records.frame([records.pack(7, np.array([1, 2, 3], "<u2"), 2)])[0]
    assert records.unpack(records.unframe([framed])[0])[1].tolist() == [1, 2, 3]
    for at in (0, 9, 14, len(framed) - 1):
        broken = bytearray(framed)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe([bytes(broken)])


def test_records_round_trip(spark):
    rows = [(i * 3, t, "s", "en") for i, t in enumerate(HARD)] + [(9, "dup", "s", "en"), (9, "dup", "s", "en"), (None, "n", "s", "en")]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as slice", "2 as ids")
    folder = records.new_folder(spark, "test-records")
    index = records.write(df, PATH, folder, slice_bytes=40)
    assert index.select("slice").distinct().count() > 3
    assert index.groupBy("slice").agg({"file": "min"}).count() == index.select("file").distinct().count()
    shuffled = records.read(index.orderBy("length", "offset"), folder)
    got = sorted((r.record_doc_id, bytes(r.ids)) for r in shuffled.collect() if r.doc_id is not None)
    want = sorted((d, np.array([*expected(t), 2], "<u4").tobytes()) for d, t, *_ in rows if d is not None)
    assert got == want
    found = sorted(map(tuple, records.round_trip(df.where("doc_id is null or doc_id <> 9"), PATH).collect()), key=lambda r: r[1])
    start, want = 0, []
    for doc, text, *_ in sorted((r for r in rows if r[0] != 9), key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*expected(text), 2], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == want
    assert records.round_trip(df.limit(0), PATH).count() == 0


def test_records_in_hundreds_of_slices(spark):
    ids = [None, *range(-300, 300, 2)]
    df = spark.createDataFrame([(i, f"text {i}", "s", "en") for i in ids], DOCS)
    index = records.write(df, PATH, records.new_folder(spark, "test-slices"), slice_bytes=1).collect()
    assert len({r.slice for r in index}) > 250
    of = {r.doc_id: r.slice for r in index}
    assert len(index) == len(of) == len(ids) and list(of[i] for i in ids) == sorted(of.values())


def test_rollup_by_deltas(spark):
    rows = [(1, "a b", "s", "en"), (2, "c", "s", None), (3, " ", None, "en"), (4, None, "s", "en"), (5, "a b", "s", "en"), (5, "a b", "s", "en")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' as tokenizer", "9 as n_tokens")
    found = sorted(map(tuple, token_counts.maintained(docs, PATH, "bpe").collect()), key=str)
    n = len(expected("a b"))
    want = [("s", "en", "bpe", 3, 3 * n), ("s", None, "bpe", 1, 1), ("s", "en", "bytes", 3, 9), ("s", None, "bytes", 1, 1)]
    assert found == sorted(want, key=str)
    assert token_counts.maintained(docs.limit(0), PATH, "bpe").count() == 0


def test_registered_counts_cover_every_document(spark, folder):
    rows = [(1, "a b", "s", "en"), (2, None, "s", "en"), (3, "", "s", None), (4, " \n\t ", None, "en"), (None, " ", "s", "en"), (4, "c", "s", "en")]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    found = {tuple(r) for r in queries.op3_token_counts(spark, folder).collect()}
    want = set()
    for source, lang in {r[2:] for r in rows}:
        texts = [t for _, t, *of in rows if tuple(of) == (source, lang)]
        want.add((source, lang, "byte_bpe_50k", len(texts), sum(len(expected(t)) for t in texts)))
        want.add((source, lang, "bytes", len(texts), sum(len((t or "").encode()) for t in texts)))
    assert found == want


def test_rollup_commits_once_and_survives_compaction(spark):
    kind = "doc_id long, source string, lang string, tokenizer string, n_tokens long"
    counts = lambda *rows: spark.createDataFrame(list(rows), kind)
    store = token_counts.Rollup(spark, token_counts.new_folder(spark, "test-rollup"))
    assert store.totals().count() == 0 and not store.compact()
    assert store.commit(1, token_counts.signed(None, counts((1, "a", "en", "v1", 5), (2, "a", "en", "v1", None))))
    assert not store.commit(1, token_counts.signed(None, counts((1, "a", "en", "v1", 5))))
    assert store.compact()
    revised = token_counts.signed(counts((1, "a", "en", "v1", 5)), counts((1, "b", "en", "v1", 7)))
    assert store.commit(2, revised) and not store.commit(2, revised) and not store.commit(1, revised)
    assert store.commit(3, token_counts.signed(counts((2, "a", "en", "v1", None)), None))
    assert store.compact()
    assert list(map(tuple, store.totals().collect())) == [("b", "en", "v1", 1, 7)]


def test_a_late_writer_of_a_compacted_number_counts_nothing(spark):
    kind = "doc_id long, source string, lang string, tokenizer string, n_tokens long"
    counts = lambda *rows: token_counts.signed(None, spark.createDataFrame(list(rows), kind))
    for late in ("batch-0", "batch-z"):  # a name before and one after that of the first writer
        store = token_counts.Rollup(spark, token_counts.new_folder(spark, "test-rollup"))
        changes = counts((1, "a", "en", "v1", 5))
        written = store.store(1, changes)  # a second writer, past the check of the journal
        shutil.move(f"{store.folder}/deltas/{written}", f"{store.folder}/deltas/{late}")
        assert store.commit(1, changes) and store.compact()
        store.publish(1, late)
        want = [("a", "en", "v1", 1, 5)]
        assert list(map(tuple, store.totals().collect())) == want
        assert store.commit(2, counts((2, "b", "en", "v1", 7))) and store.compact() and not store.commit(1, changes)
        want.append(("b", "en", "v1", 1, 7))
        assert sorted(map(tuple, store.totals().collect())) == want
        assert store.vacuum() == 4 and sorted(map(tuple, store.totals().collect())) == want
        assert len(os.listdir(f"{store.folder}/deltas")) == 1


def test_records_of_repeated_doc_ids_are_spread(spark):
    df = spark.createDataFrame([(None if i % 2 else 5, f"text {i}", "s", "en") for i in range(60)], DOCS)
    folder = records.new_folder(spark, "test-repeats")
    index = records.write(df, PATH, folder, slice_bytes=40)
    files = index.groupBy("file").count().collect()
    assert len(files) > 6 and max(r["count"] for r in files) < 20
    found = sorted(bytes(r.ids) for r in records.read(index, folder).collect())
    assert found == sorted(np.array([*expected(f"text {i}"), 2], "<u4").tobytes() for i in range(60))
