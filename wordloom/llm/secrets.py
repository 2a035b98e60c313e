"""Secret scans over an incremental blob ledger.

Texts are addressed by their content. The ledger is a table of the blobs scanned so far, with the rule
versions applied and the spans found; a scan reads only the pairs of blob and rule version that are not
in it, appends them, and joins the findings back to every path that holds the blob. All of it is made of
DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.plans.stages import stage

LEDGER = "blob binary, rules array<string>, spans array<struct<start:int,rule_no:int,end:int,kind:string>>"


@dataclass(frozen=True)
class Rule:
    """``least`` characters are asked of ``group`` of a match; a change of either needs another version."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns of the base rules. In the second and third a match is a longest run, so the
# least length can stand in the pattern.
BASE_RULES = [
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}"),
]
RULES = [
    *BASE_RULES,
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]


def scan(docs: DataFrame, ledger: str, path: str = "doc_id", text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """(path, blob, spans) of every row, the table ``ledger`` extended by what it did not have.

    Spans are (start, rule_no, end, kind) in code points, end exclusive, by start, then by the order of
    ``rules``; matches of a rule are leftmost and do not overlap. NULL texts are empty texts. Rows that
    repeat, and NULL paths, each keep their row. An empty table gives an empty result.

    A text moves once, to be met with the blobs that are new; copies of a blob send their hash alone.
    """
    if len({rule.kind for rule in rules}) < len(rules):
        raise ValueError("a kind has two rules")
    spark = docs.sparkSession
    rows = docs.select(F.col(path).alias("path"), F.coalesce(text, F.lit("")).alias("text")).withColumn(
        "blob", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))
    )
    paths = stage(rows.select("path", "blob"), "secret_paths").table
    known = read_ledger(spark, ledger)
    asked = F.array(*[F.lit(rule.key) for rule in rules])
    todo = paths.groupBy("blob").agg(F.min("path").alias("first_path"))
    if known is not None:
        done = known.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("done"))
        left = F.array_except(asked, F.coalesce("done", F.array().cast("array<string>")))
        todo = todo.join(done, "blob", "left").select("blob", "first_path", left.alias("rules")).where(F.size("rules") > 0)
    else:
        todo = todo.select("blob", "first_path", asked.alias("rules"))
    todo = stage(todo, "secret_todo").table
    new = todo.select("blob", "rules").join(_spans(rows, todo, rules), "blob", "left")
    new.select("blob", "rules", F.coalesce("spans", F.array().cast(new.schema["spans"].dataType)).alias("spans")).write.mode(
        "append"
    ).parquet(ledger)
    return paths.join(findings(read_ledger(spark, ledger), rules), "blob", "left").select(
        F.col("path").alias(path), "blob", F.coalesce("spans", F.array().cast(new.schema["spans"].dataType)).alias("spans")
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """LEDGER rows, None where nothing has been scanned yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def findings(ledger: DataFrame, rules: list[Rule]) -> DataFrame:
    """(blob, spans) of the blobs with a span of one of the rule versions, ordered as the rules are now."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    wanted = F.array(*[F.lit(rule.key) for rule in rules])
    current = ledger.where((F.size("spans") > 0) & F.arrays_overlap("rules", wanted))
    # A row's rules name one version of a kind, so they tell that of its spans.
    asked = F.transform(F.array_intersect("rules", wanted), lambda key: F.regexp_replace(key, "@[0-9]+$", ""))
    current = current.withColumn("spans", F.filter("spans", lambda s: F.array_contains(asked, s["kind"]))).where(F.size("spans") > 0)
    ordered = current.select(
        "blob",
        F.transform("spans", lambda s: s.withField("rule_no", (F.array_position(kinds, s["kind"]) - 1).cast("int"))).alias("spans"),
    )
    return ordered.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def _spans(rows: DataFrame, todo: DataFrame, rules: list[Rule]) -> DataFrame:
    """(blob, spans) of the blobs of ``todo`` with a match of a rule asked of them."""
    met = rows.join(
        todo.select("first_path", F.col("blob").alias("_blob"), "rules").hint("shuffle_hash"),
        F.col("path").eqNullSafe(F.col("first_path")) & (F.col("blob") == F.col("_blob")),
    )
    parts = F.flatten(F.array(*[_matches(F.col("text"), i, rule) for i, rule in enumerate(rules)]))
    hit = met.select("blob", parts.alias("parts")).where(F.size("parts") > 0)
    one = hit.groupBy("blob").agg(F.first("parts").alias("parts"))  # rows that repeat bring the same
    each = one.select("blob", F.explode("parts").alias("p")).select("blob", "p.*")
    so_far = Window.partitionBy("blob", "rule_no").orderBy("match_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("chars")).over(so_far).cast("int")).where("passes")
    span = F.struct((F.col("end") - F.col("chars")).alias("start"), "rule_no", "end", "kind")
    return placed.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def _matches(text: Column, rule_no: int, rule: Rule) -> Column:
    """Array of a text's matches, each with the characters before it since the last one."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    asked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    each = F.transform(
        F.arrays_zip(found.alias("found"), asked.alias("asked"), F.slice(F.split(text, rule.pattern, -1), 1, F.size(found)).alias("gap")),
        lambda m, i: F.struct(
            F.lit(rule_no).alias("rule_no"), F.lit(rule.kind).alias("kind"), i.alias("match_no"), F.length(m["gap"]).alias("gap"),
            F.length(m["found"]).alias("chars"), (F.length(m["asked"]) >= rule.least).alias("passes"),
        ),
    )
    nothing = F.array().cast("array<struct<rule_no:int,kind:string,match_no:int,gap:int,chars:int,passes:boolean>>")
    return F.when(F.array_contains("rules", rule.key) & F.rlike(text, pattern), each).otherwise(nothing)
