"""Token counts as rollups that are maintained by deltas.

A change carries the counts of a document before and after: an insert has no before, a delete no after, a revised
count both (also when the document moved to another source or language, or was counted by another tokenizer version).
Each side becomes a signed row, minus before and plus after, and all are summed by source, language and tokenizer
version; nothing is looked up, so a batch costs what its changes cost, whatever the store holds.

A batch is committed under its number: its summed deltas go to a folder that nobody else uses, and the commit is one
row in a journal that names the number and the folder. A number that the journal has is not written again, so a batch
may be replayed; of folders that raced for one number the smallest name counts. Totals are the sum of the committed
deltas. `compact` folds the batches so far into one, under a negative number, and its row lists the numbers it holds: a
number that a compaction holds never counts by itself again, also if a slow writer of that number commits later.
`vacuum` deletes the folders that count no more.

Null source, language or tokenizer are groups of their own; a null count is 0; null text has no tokens; repeated rows
count each; an empty batch commits no rows; totals of groups that fell to zero documents are left out.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.arrow import blocks, utf8
from candlewick.llm.bpe import BLOCK, tokenizer_file
from candlewick.llm.mixing import n_words
from candlewick.llm.pieces import library_encoder
from candlewick.sources.scratch import delete, materialise, new_folder

KEYS = ("source", "lang", "tokenizer")
JOURNAL = "batch long, name string, holds array<long>"
DELTAS = "source string, lang string, tokenizer string, docs long, tokens long"


def token_counts(docs: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """doc_id, source, lang, tokenizer (the version's name), n_tokens by the tokenizer library over whole texts."""
    content = tokenizer_file(docs.sparkSession, tokenizer)
    picked = docs.select("doc_id", "source", "lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(content.value)
        for batch in batches:
            data, offsets = utf8(batch.column(3))
            for first, last in blocks(offsets, BLOCK):
                _, at = encoder(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                rows = batch.slice(first, last - first).columns[:3]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(np.diff(at))], names=["doc_id", "source", "lang", "n_tokens"])

    counted = picked.mapInArrow(run, picked.drop("text").withColumn("n_tokens", F.lit(0).cast("long")).schema)
    return counted.withColumn("tokenizer", F.lit(version)).select("doc_id", *KEYS, "n_tokens")


def signed(before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """Signed rows of a batch of changes: `before` are the counts that no longer hold, `after` those that now do."""
    sides = [(df, sign) for df, sign in ((before, -1), (after, 1)) if df is not None]
    rows = [
        df.select(*KEYS, F.lit(sign).cast("long").alias("docs"), (F.coalesce("n_tokens", F.lit(0)) * sign).alias("tokens"))
        for df, sign in sides
    ]
    return functools.reduce(DataFrame.unionByName, rows)


class Rollup:
    """The store: a folder of delta tables and a journal of committed batches."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        spark.createDataFrame([], JOURNAL).write.mode("ignore").parquet(f"{folder}/journal")

    def _journal(self) -> list:
        """Every commit. One row for each batch, none of it grows with documents."""
        return self.spark.read.schema(JOURNAL).parquet(f"{self.folder}/journal").collect()

    @staticmethod
    def live(journal: list) -> list:
        """The commits that count: the smallest name of each number, unless a compaction that counts holds the number.

        Compactions hold the numbers of those before them as well, so the newest ones settle the others.
        """
        won: dict = {}
        for r in sorted(journal, key=lambda r: r.name):
            won.setdefault(r.batch, r)
        held: set = set()
        for r in sorted(won.values(), key=lambda r: r.batch):  # the last compaction has the smallest number
            if r.batch not in held:
                held |= set(r.holds)
        return [r for r in won.values() if r.batch not in held]

    def commit(self, batch: int, changes: DataFrame, holds: list[int] | None = None) -> bool:
        """Sum and commit the signed rows of a batch; False, and nothing changes, if the number is committed."""
        if any(r.batch == batch for r in self._journal()):
            return False
        name = self.store(batch, changes)
        self.publish(batch, name, holds)
        return True

    def store(self, batch: int, changes: DataFrame) -> str:
        """Write the sums of a batch, which count once `publish` has put them into the journal."""
        name = os.path.basename(new_folder(self.spark, f"batch-{batch}"))
        sums = changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.where("docs <> 0 or tokens <> 0").write.parquet(f"{self.folder}/deltas/{name}")
        return name

    def publish(self, batch: int, name: str, holds: list[int] | None = None) -> None:
        row = self.spark.createDataFrame([(batch, name, holds or [])], JOURNAL)
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/journal")

    def _tables(self, commits: list) -> DataFrame:
        paths = [f"{self.folder}/deltas/{r.name}" for r in commits]
        if not paths:
            return self.spark.createDataFrame([], DELTAS)
        return self.spark.read.schema(DELTAS).parquet(*paths)

    def deltas(self) -> DataFrame:
        return self._tables(self.live(self._journal()))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens."""
        summed = self.deltas().groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return summed.where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> bool:
        """Fold what counts into one table, under a negative number of its own."""
        journal = self._journal()
        live = self.live(journal)
        number = min([0, *(r.batch for r in journal)]) - 1
        holds = {r.batch for r in live} | {b for r in live for b in r.holds}
        return bool(live) and self.commit(number, self._tables(live), sorted(holds))

    def vacuum(self) -> int:
        """Delete the folders of commits that count no more; run it when nobody reads them. Returns their number."""
        journal = self._journal()
        live = {r.name for r in self.live(journal)}
        gone = [r.name for r in journal if r.name not in live]
        for name in gone:
            delete(self.spark, f"{self.folder}/deltas/{name}")
        return len(gone)


def maintained(docs: DataFrame, tokenizer: str, version: str, restored: bool = False) -> DataFrame:
    """Totals of a store that took three batches or four, each one sent twice, and was compacted in between.

    1: all documents are inserted, counted in words (version `words`) and in bytes (version `bytes`). 2: documents
    without a word are deleted. 3, if `restored`: they come back, so that the totals cover every document. Last: the
    counts in words of the documents held are revised to tokens of `tokenizer`.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "source", "lang", n_words("text").alias("words"), F.octet_length("text").alias("bytes"))
    rows = materialise(rows, "plain-counts")
    by = lambda df, c: df.select("doc_id", "source", "lang", F.lit(c).alias("tokenizer"), F.col(c).cast("long").alias("n_tokens"))
    both = lambda df: by(df, "words").unionByName(by(df, "bytes"))
    wordless = both(rows.where("words = 0"))
    batches = [signed(None, both(rows)), signed(wordless, None)]
    if restored:
        batches.append(signed(None, wordless))
        held, texts = rows, docs
    else:
        held, texts = rows.where("words > 0"), docs.where(n_words("text") > 0)
    batches.append(signed(by(held, "words"), token_counts(texts, tokenizer, version)))
    store = Rollup(spark, new_folder(spark, "rollup"))
    for number, changes in enumerate(batches, 1):
        store.commit(number, changes)
        store.commit(number, changes)
        if number == 2:
            store.compact()
    return store.totals()
