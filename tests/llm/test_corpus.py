"""Near-duplicates, mixing, shards, quality rules and the pipeline against plain versions."""

import collections
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from candlewick.llm import mixing, quality, sharding, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def docs(spark, *rows):
    """Rows (doc_id, text, source) with columns whose names operators use themselves."""
    made = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)
    return made.selectExpr("*", "1 as fp", "2 as size", "3 as kept", "4 as root", "5 as target", "'y' as `a.b`")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, radius=2):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


ODD = [(5, None, "s"), (4, "", "s"), (3, " \t\n", "s"), (None, "", "s"), (9, "one", "s"), (8, "ONE", None), (7, "one two", "s")]
ODD += [(7, "one two", "s"), (None, "alone here now", None), (None, "Alone here now", "s"), (20, "É é  x", "s"), (21, "é é  x", "s")]


@pytest.mark.parametrize("largest", [2, 2048])
def test_components(spark, largest, monkeypatch):
    monkeypatch.setattr(simhash.shards, "__defaults__", (largest,))
    monkeypatch.setattr(simhash.links, "__defaults__", (2, largest))
    random.seed(4)
    words = [f"w{i}" for i in range(40)]
    base = " ".join(random.choices(words, k=300))
    near = [(100 + i, " ".join(w if random.random() > 0.004 else "zz" for w in base.split()), "s") for i in range(60)]
    rows = ODD + near + [(200, base, "s"), (201, base.upper(), "s")]
    found = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs(spark, *rows)).collect()}
    fps = [fingerprint(t) for _, t, _ in rows]
    label = groups(fps)
    least = {g: min((r[0] for r, x in zip(rows, label) if x == g and r[0] is not None), default=None) for g in label}
    assert found == {(r[0], f"{f:016x}", least[g]) for r, f, g in zip(rows, fps, label)}
    assert len({g for g in label}) < len(set(fps))  # some links join different texts


def test_first_of_each(spark):
    made = docs(spark, *ODD)
    kept = simhash.first_of_each(made)
    assert kept.columns == made.columns
    assert sorted((r.doc_id, lower(r.text)) for r in kept.collect() if r.doc_id) == [(3, " \t\n"), (7, "one two"), (8, "one"), (20, "É é  x"), (21, "é é  x")]
    assert [lower(r.text) for r in kept.where("doc_id is null").collect()] == ["alone here now"]
    assert simhash.first_of_each(made.limit(0)).count() == 0 and simhash.near_duplicates(made.limit(0)).count() == 0


def test_first_of_each_where_ids_repeat_with_other_texts(spark):
    a, b, c = "alone here now", "quite another text of words", "some third thing to read"
    rows = [(5, a, "s"), (5, b, "s"), (7, a, "s"), (7, c, "s"), (7, c, "s"), (9, b, "s"), (9, a, "s")]
    assert len(set(groups([fingerprint(t) for t in (a, b, c)]))) == 3
    kept = simhash.first_of_each(docs(spark, *rows))
    assert kept.columns == docs(spark, *rows).columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(5, a), (5, b), (7, c)]
    kept = simhash.first_of_each(docs(spark, (5, a, "s"), (7, a, "s"), (7, b, "s")))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(5, a), (7, b)]


def test_trees_find_what_all_pairs_find():
    rng = np.random.default_rng(2)
    values = np.unique(rng.integers(0, 1 << 10, 300).astype(np.uint64) << np.uint64(27))
    tree = np.repeat([0, 1], [100, len(values) - 100])
    edges = simhash.bk_trees(values, tree)
    a, b = simhash.search(values, edges, np.arange(len(values)), np.where(tree, 100, 0), 2)
    want = {(i, j) for i in range(len(values)) for j in range(len(values)) if i != j and tree[i] == tree[j] and (int(values[i]) ^ int(values[j])).bit_count() <= 2}
    assert set(zip(a.tolist(), b.tolist())) == want


def test_every_near_pair_meets_in_a_shard(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**62), 2**62, 30)
    pairs = [(int(v), int(v) ^ int(sum(1 << int(b) for b in rng.choice(63, 2, False)))) for v in base]
    for largest in (2, 4096):
        rows = spark.createDataFrame([(x,) for x in {x for p in pairs for x in p}], "fp long")
        met = collections.defaultdict(set)
        for r in simhash.shards(rows, largest).collect():
            met[r.shard].add(r.fp)
        assert all(any({a, b} <= s for s in met.values()) for a, b in pairs)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(900, 901)], "a long, b long")
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, 901: 900}


def targets(sizes):
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    total, full = sum(sizes.values()), set()
    while True:
        left, over = total - sum(3 * sizes[s] for s in full), sum(w for s, w in weight.items() if s not in full)
        more = {s for s in sizes if s not in full and weight[s] * left > 3 * sizes[s] * over}
        if not more:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * left / over for s in sizes}
        full |= more


def test_mix(spark):
    random.seed(5)
    rows = [(i, " ".join(["w"] * random.randint(0, 40)), random.choice(["a", "b", "Z", "é", None])) for i in range(400)]
    rows += [(1000, "x " * 30, "tiny"), (1001, None, "none"), (None, "y y", "a"), (3, "repeat", "a"), (3, "repeat", "a")]
    made = docs(spark, *rows)
    found = mixing.mix(made).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    aim = targets(sizes)
    assert sorted((r.target, r.source_size) for r in found) == sorted((aim[s], sizes[s]) for _, _, s in rows)
    assert all(r.taken <= 3 * r.size and r.taken >= 0 for r in found)
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, mixing.mix(made.repartition(7)).collect()), key=str)
    whole = mixing.mixed(made)
    assert whole.columns == made.columns
    want = {r.doc_id: r.taken // r.size for r in found if r.size and r.doc_id not in (3, None)}
    count = collections.Counter(r.doc_id for r in whole.where("doc_id is not null and doc_id <> 3").collect())
    assert all(count[d] == n for d, n in want.items())
    assert mixing.mix(made.limit(0)).count() == 0 and mixing.mixed(made.limit(0)).count() == 0


def test_shards(spark):
    rows = [(i, "t" * (i % 50), "s") for i in range(997)] + [(None, None, "s"), (None, "", "s")] + [(5, "same", "s")] * 300
    made = docs(spark, *rows)
    found = sharding.shard(made, 7).collect()
    by = collections.defaultdict(list)
    for r in found:
        by[r.shard].append(r.slot)
    assert sorted(by) == list(range(7)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    import zlib

    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in found), key=str) == want
    assert {(r.law, r.grown_shard) for r in found} == {("rows", None)}
    again = sharding.shard(made.repartition(3), 7).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert sharding.shard(made.limit(0), 7).count() == 0


def test_one_more_shard_moves_few_rows(spark):
    made = docs(spark, *((i, f"text {i}", "s") for i in range(4000)))
    before = {r.doc_id: r.shard for r in sharding.shard(made, 20).collect()}
    after = {r.doc_id: r.shard for r in sharding.shard(made, 21).collect()}
    assert sum(before[d] != after[d] for d in before) < 0.25 * len(before)  # all but 1 in 21 for a hash modulo


def test_overflow_goes_clockwise():
    owner = [0, 1, 2] + [0] * (sharding.PLACES - 3)
    found = sharding.bounded_loads({0: 7, 1: 1, 2: 1}, owner, 3)
    assert sorted(found) == [(0, 0, 3, 0, 0), (0, 3, 5, 1, 1), (0, 5, 7, 2, 1), (1, 0, 1, 1, 0), (2, 0, 1, 2, 0)]


def statistics(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    marked = {i + s for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for s in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked), failed


@pytest.mark.parametrize("repeats", [3, 10_000])
def test_shards_equal_a_walk_row_by_row(spark, monkeypatch, repeats):
    monkeypatch.setattr(sharding, "REPEATS", repeats)
    rng = random.Random(12)
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, "", "a", "bb", "é"]), "s") for _ in range(150)] + [(7, "often", "s")] * 40
    made = docs(spark, *rows)
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = made.select("doc_id", "text", F.xxhash64(text).alias("h"), F.crc32(text.cast("binary")).alias("crc"))
    place = F.pmod(F.xxhash64(F.lit("row"), F.col("doc_id"), F.col("h")), F.lit(sharding.PLACES))
    placed = [(r.place, r.h, r.doc_id is not None, r.doc_id or 0, r.crc, r) for r in hashed.withColumn("place", place).collect()]
    nodes = spark.range(5 * sharding.NODES).select(F.pmod(F.xxhash64(F.lit("node"), F.col("id")), F.lit(sharding.PLACES)).alias("p"), "id")
    at = {}
    for r in nodes.collect():
        at[r.p] = min(at.get(r.p, 5), r.id // sharding.NODES)

    def owner(place):
        while place % sharding.PLACES not in at:
            place += 1
        return at[place % sharding.PLACES]

    room = [len(rows) // 5 + (s < len(rows) % 5) for s in range(5)]
    slots, want, refused = [0] * 5, [], []

    def put(row, shard):
        want.append((row.doc_id, len((row.text or "").encode()) + 16, row.crc, shard, slots[shard]))
        slots[shard] += 1

    for entry in sorted(placed, key=lambda e: e[:5]):
        if slots[owner(entry[0])] < room[owner(entry[0])]:
            put(entry[5], owner(entry[0]))
        else:
            refused.append(entry)
    for entry in refused:
        step = entry[0]
        while slots[owner(step)] >= room[owner(step)]:
            step += 1
        put(entry[5], owner(step))
    found = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in sharding.shard(made, 5).collect()]
    assert sorted(found, key=str) == sorted(want, key=str) and refused


def plain_score(model, text):
    """The model's score gram by gram."""
    word = lambda w: sum(ord(c) * pow(int(quality._ODD[0]), i + 1, 1 << 32) for i, c in enumerate(w)) % (1 << 32)
    words = [word(w) for w in WORD.findall(text)]
    codes = [ord(c) for c in text]
    score = model.bias
    for kind, (values, n) in enumerate([(words, 1), (words, 2), (codes, 2), (codes, 3), (codes, 4)]):
        weights = []
        for i in range(len(values) - n + 1):
            h = sum((values[i + k] + 1) * int(quality._ODD[k]) for k in range(n)) % (1 << 32)
            bucket = ((h ^ h >> 15) * int(quality._ODD[-1]) % (1 << 32)) >> (33 - quality.BUCKETS.bit_length())
            weights.append(float(model.weights[kind][bucket]))
        score += sum(weights) / max(1, len(weights))
    return score


def test_verdicts_equal_a_plain_scorer(spark):
    made, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    made = made.unionByName(spark.createDataFrame([(-1, "é 日本 " * 60, None, None, 0), (-2, None, None, None, 0)], made.schema))
    model = quality.train(made, labels)
    texts = {r.doc_id: r.text or "" for r in made.collect()}
    for r in quality.rate(made, labels).collect():
        chance = 1 / (1 + np.exp(-np.clip(model.slope * plain_score(model, texts[r.doc_id]) + model.shift, -60, 60)))
        assert r.probability == pytest.approx(chance, rel=1e-6, abs=1e-12)
        assert r.kept == (not r.base_failed and chance >= quality.THRESHOLD)


def test_repeated_labelled_rows_push_nobody_out(spark):
    made, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    one = made.join(labels.where("quality = 1"), "doc_id", "left_semi").limit(1)
    many = made.unionByName(one.crossJoin(spark.range(50)).drop("id"))
    plain, crowded = quality.train(made, labels, 20), quality.train(many, labels, 20)
    assert crowded is not None and np.array_equal(plain.weights, crowded.weights) and plain.slope == crowded.slope


def test_quality_statistics(spark):
    random.seed(6)
    texts = [t for _, t, _ in ODD] + ["a b c a b c", "x\n\nx\n \nx y", "é|<>日本 " * 60, "supercalifragilistic" * 40 + " a" * 70]
    texts += [" ".join(random.choices("a b c d e f g".split(), k=random.randint(0, 120))) for _ in range(60)]
    made = docs(spark, *((i, t, "s") for i, t in enumerate(texts)))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    names = (*quality.STATISTICS, "base_failed", "kept")
    found = {r.doc_id: tuple(r[n] for n in names) for r in quality.rate(made, labels).collect()}
    assert found == {i: (*statistics(t), not statistics(t)[-1]) for i, t in enumerate(texts)}
    kept = quality.kept_rows(made, labels)
    assert kept.columns == made.columns and {r.doc_id for r in kept.collect()} == {i for i, f in found.items() if f[-1]}
    assert quality.rate(made.limit(0), labels).count() == 0


def test_quality_model_on_rows_it_has_not_seen(spark):
    table = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    labels = table("labels")
    train, test = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    found = quality.rate(table("documents"), train).join(test, "doc_id").where("not base_failed").collect()
    right = sum(r.kept == (r.quality == 1) for r in found)
    assert len(found) > 80 and right / len(found) > 0.97
    sure = [r for r in found if r.probability > 0.9]
    assert sum(r.quality for r in sure) / len(sure) > 0.95


def test_pipeline(spark):
    import corpus_pipeline as pipeline
    from candlewick.llm.queries import TOKENIZER
    import tokenizers

    table = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    source = table("documents")
    kept = pipeline.quality_rules(spark, source, SF)
    assert kept.columns == source.columns and 0 < kept.count() < source.count()
    judged = {r.doc_id for r in quality.rate(source, table("labels")).where("kept").collect()}
    rows = sorted((r.doc_id, r.text, r.source) for r in kept.collect())
    assert {r[0] for r in rows} == judged
    label = groups([fingerprint(t) for _, t, _ in rows])
    first = [r for i, r in enumerate(rows) if label[i] == i]
    deduped = pipeline.near_duplicates(spark, kept, SF)
    assert deduped.columns == source.columns and sorted((r.doc_id, r.text, r.source) for r in deduped.collect()) == first
    sizes = collections.Counter()
    for _, t, s in first:
        sizes[s] += len(WORD.findall(t))
    aim, mixed = targets(sizes), pipeline.mix_sources(spark, deduped, SF)
    count = collections.Counter(r.doc_id for r in mixed.collect())
    assert all(0 <= count[d] - int(aim[s] / sizes[s]) <= 1 for d, t, s in first) and set(count) <= {r[0] for r in first}
    library = tokenizers.Tokenizer.from_file(TOKENIZER)
    final = pipeline.run(spark, SF).collect()
    ids = {d: library.encode(t, add_special_tokens=False).ids for d, t, _ in first}
    assert all(r.exact and np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id] and r.n_tokens == len(ids[r.doc_id]) for r in final)
    assert collections.Counter(r.doc_id for r in final) == count
    empty = source.limit(0)
    for _, stage in pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
