"""URL filter: a tree of path templates per host, judged by the labelled pages below each template.

Every url that a rule fits is labelled by it. Level by level, a path segment stays literal only where
it has MIN_ROWS rows or more and its labelled share differs from that of its siblings; all other siblings are
variable or alike and are merged under a wildcard. A template's blocked share is smoothed towards its
parent's, up to the host and a root rate, and the template is rejected at THRESHOLD.

DataFrame operations only. Rows meet the tree through tables of kept segments, one for MIN_ROWS rows at
most; those joins are salted, so a host with a large share of all rows is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulframe.llm.landed import landed

DEPTH = 3  # levels of the tree; what lies deeper is one tail, **
MIN_ROWS = 5  # rows that a literal segment has at least
DIFFERENT = 3.84  # squared z of two shares, 5 % level
STRENGTH = 4.0  # labelled rows that the parent's share counts for
ROOT_RATE = 0.25
THRESHOLD = 0.5
SALTS = 16

URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL_PATTERN, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PATTERN, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule, written ``host/path``, that fits; null if none does."""
    found = []
    for rule in sorted({r for _, r in rules}, key=lambda r: (-len(r), r)):
        name = rule.partition("/")[0]
        here = (host == name) | host.endswith("." + name)
        found.append(F.when(here & path.startswith(rule[len(name) :]), F.lit(rule)))
    return F.coalesce(*found, F.lit(None).cast("string"))


def _different(b: Column, n: Column, all_b: Column, all_n: Column) -> Column:
    """Whether the blocked share of a branch differs from that of its siblings taken together."""
    b, n, all_b, all_n = (x.cast("double") for x in (b, n, all_b, all_n))
    gap = b * (all_n - n) - (all_b - b) * n
    spread = n * (all_n - n) * all_b * (all_n - all_b)
    return (spread > 0) & (gap * gap * all_n >= F.lit(DIFFERENT) * spread)


def judged(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Per row of ``pages`` (``page_id``, ``url``): page_id, host, path, rule, verdict, template.

    A null url, or one without ``://``, has empty host and path and forms a template of its own. Rows
    are never matched by page_id, so null or repeated ids and repeated urls come back as they are.
    Other columns are not read. ``rules`` holds (allow or block, ``host/path``) and at least one rule.
    """
    verdicts = {rule: verdict for verdict, rule in rules}
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    blocked = F.col("rule").isin([r for r, v in verdicts.items() if v == "block"])
    parts = F.when(F.col("path") != "", F.split(F.expr("substring(path, 2)"), "/", -1))
    rows = rows.withColumns(
        {
            "parts": parts,
            "n": F.col("rule").isNotNull().cast("int"),
            "b": F.coalesce(blocked, F.lit(False)).cast("int"),
            "salt": F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"),
            "template": F.col("host"),
        }
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    scores = None
    for level in range(DEPTH + 1):
        nodes = rows.groupBy("template").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
        if level == 0:
            parent = nodes.withColumn("above", F.lit(ROOT_RATE))
        else:
            up = rows.select("template", "parent").distinct()
            parent = nodes.join(up, "template").join(
                scores.select(F.col("template").alias("parent"), F.col("score").alias("above")), "parent"
            )
        scores = landed(
            parent.select(
                "template",
                ((F.col("all_b") + F.lit(STRENGTH) * F.col("above")) / (F.col("all_n") + F.lit(STRENGTH))).alias("score"),
            ),
            "scores",
        )
        if level == DEPTH:
            break
        at = rows.withColumn("segment", F.get("parts", F.lit(level)))
        kept = (
            at.where("segment IS NOT NULL")
            .groupBy("template", "segment")
            .agg(F.sum("n").alias("cn"), F.sum("b").alias("cb"), F.count("*").alias("c"))
            .where(F.col("c") >= MIN_ROWS)
            .join(nodes, "template")
            .where(_different(F.col("cb"), F.col("cn"), F.col("all_b"), F.col("all_n")))
            .select("template", "segment")
        )
        kept = landed(kept, "kept").select("template", "segment", salts.alias("salt"), F.lit(True).alias("literal"))
        tail = F.when(F.size("parts") > DEPTH, F.lit("/**")).otherwise(F.lit("")) if level == DEPTH - 1 else F.lit("")
        grown = F.concat("template", F.lit("/"), F.when(F.col("literal"), F.col("segment")).otherwise(F.lit("*")), tail)
        rows = at.join(kept, ["template", "segment", "salt"], "left").withColumns(
            {"parent": F.col("template"), "template": F.when(F.col("segment").isNull(), F.col("template")).otherwise(grown)}
        )
        rows = rows.drop("segment", "literal")
    scored = rows.join(scores.select("template", "score", salts.alias("salt")), ["template", "salt"], "left")
    by_rule = F.when(F.col("b") == 1, "block").when(F.col("n") == 1, "allow")
    by_method = F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_method).alias("verdict"), "template")


def judged_sql(rules: list[tuple[str, str]], table: str = "pages") -> str:
    """The same in DuckDB's SQL."""
    cases, blocks = [], []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name = rule.partition("/")[0]
        cases.append(
            f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{rule[len(name):]}') THEN '{rule}'"
        )
        if verdict == "block":
            blocks.append(f"'{rule}'")
    sql = f"""
WITH cut AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{URL_PATTERN}', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '{URL_PATTERN}', 2), '') AS path FROM {table}
), ruled AS (SELECT *, CASE {' '.join(cases)} END AS rule FROM cut),
rows0 AS (
  SELECT page_id, host, path, rule, CASE WHEN path <> '' THEN string_split(substr(path, 2), '/') END AS parts,
         (rule IS NOT NULL)::INT AS n, coalesce(rule IN ({', '.join(blocks)}), false)::INT AS b,
         host AS template, '' AS parent FROM ruled
)"""
    for level in range(DEPTH + 1):
        above = f"{ROOT_RATE}::DOUBLE" if level == 0 else f"(SELECT max(s.score) FROM scores{level - 1} s WHERE s.template = o.parent)"
        sql += f""",
nodes{level} AS (SELECT template, any_value(parent) AS parent, sum(n) AS all_n, sum(b) AS all_b
  FROM rows{level} GROUP BY template),
scores{level} AS (SELECT template, (all_b::DOUBLE + {STRENGTH}::DOUBLE * {above}) / (all_n::DOUBLE + {STRENGTH}::DOUBLE) AS score
  FROM nodes{level} o)"""
        if level == DEPTH:
            break
        tail = f"CASE WHEN len(parts) > {DEPTH} THEN '/**' ELSE '' END" if level == DEPTH - 1 else "''"
        sql += f""",
children{level} AS (SELECT template, parts[{level + 1}] AS segment, sum(n)::DOUBLE AS cn, sum(b)::DOUBLE AS cb, count(*) AS c
  FROM rows{level} WHERE len(parts) > {level} GROUP BY ALL HAVING count(*) >= {MIN_ROWS}),
kept{level} AS (SELECT c.template, c.segment FROM children{level} c JOIN nodes{level} o USING (template)
  WHERE cn * (all_n::DOUBLE - cn) * all_b::DOUBLE * (all_n::DOUBLE - all_b::DOUBLE) > 0
    AND pow(cb * (all_n::DOUBLE - cn) - (all_b::DOUBLE - cb) * cn, 2) * all_n::DOUBLE
        >= {DIFFERENT}::DOUBLE * (cn * (all_n::DOUBLE - cn) * all_b::DOUBLE * (all_n::DOUBLE - all_b::DOUBLE))),
rows{level + 1} AS (SELECT page_id, host, path, rule, parts, n, b, r.template AS parent,
  CASE WHEN parts IS NULL OR len(parts) <= {level} THEN r.template
       ELSE r.template || '/' || CASE WHEN k.segment IS NOT NULL THEN k.segment ELSE '*' END || {tail} END AS template
  FROM rows{level} r LEFT JOIN kept{level} k ON k.template = r.template AND k.segment = parts[{level + 1}])"""
    return (
        sql
        + f"""
SELECT page_id, host, path, rule,
  CASE WHEN b = 1 THEN 'block' WHEN n = 1 THEN 'allow' WHEN score >= {THRESHOLD} THEN 'block' ELSE 'allow' END AS verdict,
  template FROM rows{DEPTH} LEFT JOIN scores{DEPTH} USING (template)"""
    )
