"""How filters interact: what each one removes, in every order in which they can be applied.

Each filter has a table of the ids that fail it. What a filter removes after others have gone before it depends
on which went before, not on their order, so the prefixes are sets: 2 to the number of filters. The survivors
of a prefix are those of a shorter one without (left anti) the failing ids of one more filter, and what the
next filter removes is survivors with (left semi) its failing ids. Prefixes of one size are worked off
together, as rows with the prefix beside the id. All tables are bucketed by id, so no join moves a row.
"""

from __future__ import annotations

import uuid
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulframe.llm.landed import landed
from haulframe.operators.joins import lookup
from haulframe.sources.scratch import new_path

# The filters of the audit.
FEWEST_WORDS = 200
LEAST_DISTINCT = 50  # per cent of the words
MOST_CAPITALS = 2  # per cent of the characters
WORD_BREAKS = r"[\x20\x09-\x0D]+"
MARKS = "[#$%&*|]"
BUCKET_ROWS = 10_000  # documents of a bucket of the id tables, as far as the session has partitions
COPIES = "E"  # the filter that compares rows


def text_filters(text: str = "text") -> dict[str, Column]:
    """Failure conditions that look at one text alone; a null text is empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(t, WORD_BREAKS), "")
    capitals = F.length(t) - F.length(F.regexp_replace(t, "[A-Z]+", ""))
    return {
        "A": F.size(words) < FEWEST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * capitals > MOST_CAPITALS * F.length(t),
        "D": t.rlike(MARKS),
    }


def audited_rows(docs: DataFrame, filters: dict[str, Column] | None = None) -> DataFrame:
    """``id`` (a number of the row), doc_id, part, ``fails`` (the filters it fails) and a digest of the text; written once."""
    filters = text_filters() if filters is None else filters
    fails = F.array_compact(F.array(*[F.when(fail, F.lit(name)) for name, fail in filters.items()]))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        fails.alias("fails"),
        F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("digest"),
    )
    return landed(rows.withColumn("id", F.monotonically_increasing_id()), "audited")


class IdTables:
    """Tables bucketed by ``id``, so that joins on it move no rows. Files go to the shared folder; ``drop`` forgets the names."""

    def __init__(self, spark: SparkSession, rows: int):
        self.spark, self.names = spark, []
        most = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = max(1, min(most, -(-rows // BUCKET_ROWS)))

    def stored(self, df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
        name = f"{label}_{uuid.uuid4().hex[:12]}"
        self.names.append(name)
        writer = df.write.partitionBy(*by) if by else df.write
        writer.bucketBy(self.buckets, "id").option("path", new_path(self.spark, label)).format("parquet").saveAsTable(name)
        return self.spark.table(name)

    def dealt(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.buckets, "id")

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": name})


def failing_ids(rows: DataFrame, letters: str, tables: IdTables) -> DataFrame:
    """``id`` and ``filter`` (a bit, the n-th of the letters at 2^n); one folder and id table per filter.

    Copies of a text with a smaller doc_id fail COPIES.
    """
    texts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copied = landed(texts.where("first < last").select("digest", "first"), "copied")
    later = rows.select("id", "digest", "doc_id").join(copied, "digest").where("doc_id > first")
    own = rows.select("id", F.explode("fails").alias("letter"))
    every = own.unionByName(later.select("id", F.lit(COPIES).alias("letter")))
    bits = F.create_map(*[F.lit(x) for n, letter in enumerate(letters) for x in (letter, 1 << n)])
    return tables.stored(tables.dealt(every.select("id", bits[F.col("letter")].alias("filter"))), "failing", ("filter",))


def prefixes(rows: DataFrame, failing: DataFrame, filters: int, tables: IdTables) -> tuple[DataFrame, DataFrame]:
    """What is kept after each prefix, and what each further filter removes then, per part.

    ``rows`` holds id, part, good, toxic. Returns (part, mask, kept) and (part, mask, filter, removed,
    good_lost, toxic_lost); a mask has the bits of the filters of the prefix. Rows that fail no filter are
    kept by every prefix, so they are counted once, beside each mask.
    """
    every = tables.stored(tables.dealt(rows.select("id", "part", "good", "toxic")), "rows")
    failing = failing.hint("merge")
    clean = every.join(failing, "id", "left_anti").groupBy("part").agg(F.count("*").alias("kept"))
    kept = [landed(clean, "clean").withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1)))).select("part", "mask", "kept")]
    alive = tables.stored(every.join(failing, "id", "left_semi").withColumn("mask", F.lit(0)), "alive_0")
    removed = []
    for done in range(filters + 1):
        kept.append(alive.groupBy("part", "mask").agg(F.count("*").alias("kept")))
        if done == filters:
            break
        each = F.explode(F.array(*[F.lit(1 << n) for n in range(filters)])).alias("next")
        tried = alive.select("*", each).where(F.col("mask").bitwiseAND(F.col("next")) == 0)
        # the filter is told apart by its bit, not as a key, so that the id alone deals both sides
        fails = (tried["id"] == failing["id"]) & (tried["next"].bitwiseAND(failing["filter"]) != 0)
        gone = tried.join(failing, fails, "left_semi")
        counts = [F.count("*").alias("removed"), F.count_if("good").alias("good_lost"), F.count_if("toxic").alias("toxic_lost")]
        removed.append(landed(gone.groupBy("part", "mask", F.col("next").alias("filter")).agg(*counts), "removed"))
        # a set of filters is reached once, by its letters in order
        left = tried.where("next > mask").join(failing, fails, "left_anti")
        longer = left.select("id", "part", "good", "toxic", (F.col("mask") + F.col("next")).alias("mask"))
        alive = tables.stored(longer, f"alive_{done + 1}")
    sums = reduce(DataFrame.unionAll, kept).groupBy("part", "mask").agg(F.sum("kept").alias("kept"))
    return landed(sums, "kept"), reduce(DataFrame.unionAll, removed)


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None) -> DataFrame:
    """One row per part (source), order of all filters and step; counts of documents within the part.

    kept (after the step), removed (by it), redundant (fail its filter, removed before), unique_fails (fail its
    filter only), good_lost and toxic_lost (removed here, by ``labels``), shapley (removed by its filter, summed
    over all orders). Null texts are empty, a null source is the part ''. Rows are counted one by one, repeated
    ones and those with a null doc_id too; the latter have no label and are no copies, and rows with one
    doc_id are no copies of one another. Of several labels of a document, one that marks it counts. No documents
    give no rows.
    """
    filters = text_filters() if filters is None else filters
    letters = "".join(sorted({*filters, COPIES}))
    rows = audited_rows(docs, filters)
    tables = IdTables(docs.sparkSession, rows.count())
    failing = failing_ids(rows, letters, tables)
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    marked = lookup(rows.select("id", "part", "doc_id"), marks, ["doc_id"], "left", grows=True)
    no = F.lit(False)
    kept, removed = prefixes(
        marked.select("id", "part", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")), failing, len(letters), tables
    )
    tables.drop()

    full = (1 << len(letters)) - 1
    before = F.bit_count("mask")
    facts = removed.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("mask") == 0, F.col("removed"))).alias("failing"),
        F.sum(F.when(F.col("mask") == F.lit(full) - F.col("filter"), F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * F.factorial(before) * F.factorial(F.lit(len(letters) - 1) - before)).alias("shapley"),
    )
    steps = orders(letters)
    table = docs.sparkSession.createDataFrame(
        [(n, order, step, mask, after, after - mask) for n, (order, step, _, mask, after) in enumerate(steps)],
        "n int, filter_order string, step int, mask int, after int, filter int",
    )
    parts = kept.select("part").distinct().withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))))
    # the orders are a table of fixed size: the factorial of the filters times their number
    out = parts.join(F.broadcast(table), "n")
    out = out.join(removed, ["part", "mask", "filter"], "left").join(facts, ["part", "filter"], "left")
    out = out.join(kept.withColumnRenamed("mask", "after"), ["part", "after"], "left")
    count = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("kept", "removed", "unique_fails", "good_lost", "toxic_lost", "shapley")}
    redundant = (F.coalesce("failing", F.lit(0)) - F.coalesce("removed", F.lit(0))).cast("bigint").alias("redundant")
    return out.select(
        "part", "filter_order", "step", count["kept"], count["removed"], redundant, count["unique_fails"], count["good_lost"], count["toxic_lost"], count["shapley"]
    )


def orders(letters: str) -> list[tuple[str, int, str, int, int]]:
    """Per order and step: the order, the step, its filter, the filters before it and those after it, as masks."""
    out = []
    for order in permutations(letters):
        mask = 0
        for step, letter in enumerate(order, 1):
            after = mask | 1 << letters.index(letter)
            out.append(("".join(order), step, letter, mask, after))
            mask = after
    return out


def audit_sql() -> str:
    """The rows of ``audit`` over ``documents`` and ``labels``."""
    steps = ", ".join(f"('{o}', {s}, '{x}', {m}, {a})" for o, s, x, m, a in orders("ABCDE"))
    return f"""WITH marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
fails AS (
  SELECT doc_id, part,
    (CASE WHEN len(words) < {FEWEST_WORDS} THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '{MARKS}') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS f
  FROM texts),
counts AS (
  SELECT part, f, count(*) AS n, count_if(good = 1) AS good, count_if(toxic = 1) AS toxic
  FROM fails LEFT JOIN marks USING (doc_id) GROUP BY part, f),
steps(filter_order, step, letter, mask, after_mask) AS (VALUES {steps}),
sums AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN f & after_mask = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN f & mask = 0 AND f & after_mask <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN f & mask <> 0 AND f & (after_mask - mask) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN f = after_mask - mask THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN f & mask = 0 AND f & after_mask <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN f & mask = 0 AND f & after_mask <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM sums"""
