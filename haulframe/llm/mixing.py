"""Mix sources to target weights by hierarchical budgeting.

A leaf is a (domain, language, source). The budget is handed down the tree: each node divides what it
got among its children by weight, and no child gets more than its documents can give in ``max_epochs``
epochs. What a full child cannot take goes to its siblings first; only what a whole subtree cannot
take goes to the siblings of its root. A leaf's share is whole epochs plus a prefix of one more epoch,
whose order is drawn from the seed.

DataFrame operations only. All amounts are whole tokens, divided without rounding loss. Tokens are
words: runs of characters other than ASCII white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulframe.llm.landed import columns_of, landed

WORD = r"[^\x20\x09-\x0D]+"
SEED = 17
MAX_EPOCHS = 4
BUDGET_PERCENT = 80  # of the tokens there are
OTHER = 1  # weight of a name that the table of weights does not hold

#: Weights among siblings, whole numbers, by level: domains, languages of any domain, sources of any language.
WEIGHTS = {
    "domain": {"crawl": 2, "curated": 5, "community": 3},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    "source": {"src1": 3, "src12": 2},
}
LEVELS = ("domain", "lang", "source")
SLICES = 4096  # the epoch order is summed up in so many slices per leaf before one slice is put in order


def domain_of(source: Column) -> Column:
    """Production rule for the first level: src0 is the crawl, one-digit sources are curated, the rest community."""
    return F.when(source == "src0", "crawl").when(F.length(source) <= 4, "curated").otherwise("community")


DOMAIN_SQL = "CASE WHEN source = 'src0' THEN 'crawl' WHEN length(source) <= 4 THEN 'curated' ELSE 'community' END"


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    value = F.lit(OTHER)
    for name, w in weights.get(level, {}).items():
        value = F.when(F.col(level) == name, F.lit(w)).otherwise(value)
    return value.cast("decimal(18,0)")


def _handed_down(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """``got`` per child: its part of ``budget`` by ``weight``, at most ``room``.

    Children are filled in the order of room per weight. One is full when the budget covers everything
    before it and the same level for the rest; the others share what is left, by running totals, so that
    the parts add up exactly.
    """
    # room per weight in whole steps of 1e-9, so that the order is the same everywhere
    order = Window.partitionBy(*parents).orderBy("ratio", name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    d = "decimal(38,0)"
    filled = children.withColumn("ratio", F.expr("(CAST(room AS DECIMAL(20,0)) * 1000000000) div weight")).withColumns(
        {
            "room_before": F.coalesce(F.sum("room").over(before), F.lit(0)).cast("decimal(20,0)"),
            "weight_left": F.sum("weight").over(rest).cast("decimal(18,0)"),
        }
    )
    filled = filled.withColumn(
        "full",
        F.col("room_before") * F.col("weight") + F.col("room").cast("decimal(20,0)") * F.col("weight_left")
        <= F.col("budget").cast("decimal(20,0)") * F.col("weight"),
    )
    whole = Window.partitionBy(*parents)
    share = Window.partitionBy(*parents).orderBy("full", "ratio", name)
    open_weight = F.when(~F.col("full"), F.col("weight")).otherwise(F.lit(0).cast("decimal(18,0)"))
    filled = filled.withColumns(
        {
            "left": (F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(whole), F.lit(0))).cast(
                "decimal(20,0)"
            ),
            "open_all": F.sum(open_weight).over(whole).cast("decimal(18,0)"),
            "open_upto": F.sum(open_weight).over(share.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(18,0)"),
        }
    )
    upto = F.expr("(left * open_upto) div nullif(open_all, 0)")
    previous = F.expr("(left * (open_upto - weight)) div nullif(open_all, 0)")
    return filled.withColumn("got", F.when(F.col("full"), F.col("room")).otherwise(upto - previous).cast("bigint")).drop(
        "ratio", "room_before", "weight_left", "full", "left", "open_all", "open_upto"
    )


def budgets(leaves: DataFrame, percent: int, max_epochs: int, weights: dict[str, dict[str, int]]) -> DataFrame:
    """``got`` tokens per leaf of (domain, lang, source, tokens). The budget is ``percent`` of all tokens."""
    tree = leaves.withColumn("room", F.col("tokens") * max_epochs).withColumn("top", F.lit(0))
    rooms = []
    for depth in range(1, len(LEVELS) + 1):
        path = ["top", *LEVELS[:depth]]
        rooms.append(tree.groupBy(*path).agg(F.sum("room").alias("room"), F.sum("tokens").alias("tokens")))
    everything = Window.partitionBy("top")  # one row per domain
    above = None
    for depth, level in enumerate(LEVELS, start=1):
        parents = ["top", *LEVELS[: depth - 1]]
        children = rooms[depth - 1].withColumn("weight", _weight(level, weights))
        if above is None:
            total = F.sum("tokens").over(everything).cast("bigint")
            children = children.withColumn("total", total).withColumn("budget", F.expr(f"total * {percent} div 100"))
        else:
            children = children.join(above.drop("top"), parents[1:])
        handed = _handed_down(children, parents, level)
        above = handed.select(*parents, level, F.col("got").alias("budget"))
    return handed.select(*LEVELS, "tokens", "got")


def _prepared(docs: DataFrame, domain: Column) -> DataFrame:
    """``row``, its leaf, token count ``n`` and ``key``, the part of the order key that does not depend on the epoch."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.struct(*columns_of(docs)).alias("row"),
        domain.alias("domain"),
        F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n"),
        F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text)).alias("key"),
    )


def plan(docs: DataFrame, domain: Column, weights: dict, percent: int, max_epochs: int, seed: int) -> DataFrame:
    """Per leaf: tokens, got, whole epochs, and where the prefix of the next epoch ends.

    Documents before ``last_key`` in the epoch's order are taken whole; the one at it gives its first
    ``last_take`` tokens (documents equal in id and text share them in equal parts, rounded down).
    """
    slim = landed(_prepared(docs, domain).drop("row"), "tokens").where("n > 0")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"))
    shares = landed(budgets(leaves, percent, max_epochs, weights), "shares").withColumns(
        {"epochs": F.expr("got div tokens"), "rest": F.expr("got % tokens")}
    )
    parts = slim.join(shares.where("rest > 0"), list(LEVELS)).withColumn("order_key", epoch_key(F.col("key"), seed))
    parts = parts.withColumn("slice", F.conv(F.substring("order_key", 1, 3), 16, 10).cast("int"))
    slices = parts.groupBy(*LEVELS, "slice").agg(F.sum("n").alias("in_slice"), F.first("rest").alias("rest"))
    along = Window.partitionBy(*LEVELS).orderBy("slice")
    cut = slices.withColumn("upto", F.sum("in_slice").over(along)).where("upto >= rest AND upto - in_slice < rest")
    cut = cut.select(*LEVELS, "slice", (F.col("rest") - F.col("upto") + F.col("in_slice")).alias("wanted"))
    within = parts.join(cut, [*LEVELS, "slice"]).groupBy(*LEVELS, "wanted", "order_key").agg(
        F.sum("n").alias("n"), F.count("*").alias("copies")
    )
    along = Window.partitionBy(*LEVELS).orderBy("order_key")
    ends = within.withColumn("upto", F.sum("n").over(along)).where("upto >= wanted AND upto - n < wanted")
    ends = ends.select(
        *LEVELS,
        F.col("order_key").alias("last_key"),
        F.expr("(wanted - upto + n) div copies").alias("last_take"),
    )
    # written: a table of known size is broadcast, or dealt by a shuffle of its own that a skewed join can split
    return landed(
        shares.join(ends, list(LEVELS), "left").select(
            *LEVELS, "tokens", "got", "epochs", "last_key", F.coalesce("last_take", F.lit(0)).alias("last_take")
        ),
        "leaves",
    )


def epoch_key(key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), key))


def drawn(
    docs: DataFrame,
    domain: Column | None = None,
    weights: dict[str, dict[str, int]] | None = None,
    percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: ``row`` (a struct of its columns), its leaf (``domain``, ``lang``, ``source``), ``n_tokens``,
    ``epochs`` (how often it is taken whole in full epochs) and ``take`` (tokens taken in the last, partial epoch).

    Null source or language counts as the name ''. Null and empty texts have no tokens and are never
    taken. Repeated rows are rows of their own. Weights are positive whole numbers up to a million. Only
    the table of leaves is joined to the documents, as a broadcast or a skew-split join as Spark measures it.
    """
    domain = domain_of(F.coalesce(F.col("source"), F.lit(""))) if domain is None else domain
    weights = WEIGHTS if weights is None else weights
    leaves = plan(docs, domain, weights, percent, max_epochs, seed)
    rows = _prepared(docs, domain).join(leaves.select(*LEVELS, "epochs", "last_key", "last_take"), list(LEVELS), "left")
    at = epoch_key(F.col("key"), seed)
    take = (
        F.when(F.col("n") == 0, 0)
        .when(at < F.col("last_key"), F.col("n"))
        .when(at == F.col("last_key"), F.col("last_take"))
        .otherwise(0)
    )
    epochs = F.when(F.col("n") > 0, F.coalesce("epochs", F.lit(0))).otherwise(0)
    return rows.select(
        "row", *LEVELS, F.col("n").alias("n_tokens"), epochs.cast("bigint").alias("epochs"), take.cast("bigint").alias("take")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: each document as often as it was drawn, with the columns of ``docs``.

    The document where a prefix ends is cut to its first tokens, joined by single spaces.
    """
    text = F.col("row.text")
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col("take").cast("int")), " ")
    pieces = F.concat(
        F.array_repeat(F.lit(True), F.col("epochs").cast("int")),
        F.when(F.col("take") > 0, F.array(F.col("take") == F.col("n_tokens"))).otherwise(F.array().cast("array<boolean>")),
    )
    out = drawn(docs, **options).where("epochs > 0 OR take > 0").select("row", "take", F.explode(pieces).alias("whole"))
    made = {"text": F.when(F.col("whole"), text).otherwise(cut)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        made["n_chars"] = F.when(F.col("whole"), F.col("row.n_chars")).otherwise(F.length(cut).cast(kind))
    return out.select(*[made[c].alias(c) if c in made else F.col("row").getField(c).alias(c) for c in docs.columns])


def drawn_sql(percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """doc_id, domain, n_tokens, epochs, take in DuckDB's SQL, in one window per leaf."""

    def weight(level: str) -> str:
        return "CASE " + " ".join(f"WHEN {level} = '{k}' THEN {w}" for k, w in WEIGHTS[level].items()) + f" ELSE {OTHER} END"

    sql = f"""
WITH words AS (
  SELECT doc_id, {DOMAIN_SQL.replace('source', "coalesce(source, '')")} AS domain, coalesce(lang, '') AS lang,
         coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n,
         concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, ''))) AS key FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(n)::HUGEINT AS tokens FROM words WHERE n > 0 GROUP BY ALL
), up0 AS (SELECT 0 AS top, sum(tokens) * {percent} // 100 AS budget FROM leaves)"""
    for depth, level in enumerate(LEVELS, start=1):
        parents, path = ", ".join(["top", *LEVELS[: depth - 1]]), ", ".join(LEVELS[:depth])
        sql += f""",
a{depth} AS (SELECT 0 AS top, {path}, sum(tokens) * {max_epochs} AS room, ({weight(level)})::HUGEINT AS weight
  FROM leaves GROUP BY ALL),
b{depth} AS (SELECT *, room * 1000000000 // weight AS ratio FROM a{depth} JOIN up{depth - 1} USING ({parents})),
c{depth} AS (SELECT *, coalesce(sum(room) OVER (PARTITION BY {parents} ORDER BY ratio, {level}
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * weight
    + room * sum(weight) OVER (PARTITION BY {parents} ORDER BY ratio, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= budget * weight AS is_full FROM b{depth}),
d{depth} AS (SELECT *, budget - coalesce(sum(room) FILTER (is_full) OVER (PARTITION BY {parents}), 0) AS rest,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY {parents}) AS open_all,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY {parents} ORDER BY is_full, ratio, {level}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open_upto FROM c{depth}),
up{depth} AS (SELECT {parents}, {level}, CASE WHEN is_full THEN room
    ELSE rest * open_upto // nullif(open_all, 0) - rest * (open_upto - weight) // nullif(open_all, 0) END AS budget FROM d{depth})"""
    return (
        sql
        + f""",
shares AS (SELECT domain, lang, source, budget // tokens AS epochs, budget % tokens AS rest
  FROM up3 JOIN leaves USING (domain, lang, source)),
keyed AS (SELECT w.*, epochs, rest, md5(concat_ws(':', '{seed}', CAST(epochs AS VARCHAR), key)) AS order_key
  FROM words w LEFT JOIN shares USING (domain, lang, source)),
along AS (SELECT *, sum(n) OVER (PARTITION BY domain, lang, source ORDER BY order_key
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
  sum(n) OVER (PARTITION BY domain, lang, source, order_key) AS same,
  count(*) OVER (PARTITION BY domain, lang, source, order_key) AS copies FROM keyed)
SELECT doc_id, domain, lang, source, CAST(n AS BIGINT) AS n_tokens,
  CAST(CASE WHEN n > 0 THEN coalesce(epochs, 0) ELSE 0 END AS BIGINT) AS epochs,
  CAST(CASE WHEN n = 0 OR rest IS NULL OR upto - same >= rest THEN 0 WHEN upto <= rest THEN n
       ELSE (rest - upto + same) // copies END AS BIGINT) AS take
FROM along"""
    )
