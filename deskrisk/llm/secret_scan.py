"""Secret scans through a ledger of contents, with DataFrame functions only.

Every version of a text is addressed by the SHA-256 of its bytes. The ledger holds, for each
address, the rules (kind and version) it has been scanned with and the spans they found. A scan
takes only addresses and rules that are not in the ledger, each distinct text once, appends its
findings, and joins them back to every path that holds the text.

A rule is a regular expression of one or two groups: what comes before the secret, and the
secret. Spans cover both, in code points, end exclusive. They are found by marking the matches
in the text and adding up the lengths of the pieces between the marks.

Defined results: a null text is the empty text; repeated rows give repeated results; empty
tables give none; control characters used as marks count as one ordinary character each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskrisk.llm.workspace import released_shuffles


@dataclass(frozen=True)
class Rule:
    """``pattern`` has the groups (before)(secret); matches with a shorter secret are dropped."""

    kind: str
    pattern: str
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}:{self.version}"


# The base rules in their fixed order, then those this scanner adds.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 6),
    Rule("access", r"()(AKIA[A-Z0-9]+)", 20),
    Rule("hex", r"()([0-9a-f]+)", 24),
)
ADDED = (
    Rule("private_key", r"()(-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----)"),
    Rule("code_host", r"()(gh[pousr]_[A-Za-z0-9]{36,})"),
    Rule("chat", r"()(xox[abprs]-[A-Za-z0-9-]{10,})"),
    Rule("signed_token", r"()(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"),
    Rule("url_login", r"((?:https?|ftp|postgresql|mysql|mongodb|redis|amqp)://)([^\s/:@]+:[^\s/@]+)(?=@)"),
)
RULES = BASE + ADDED
# What a text must contain for a rule to have a span; cheaper than the rule itself.
_NEEDED = {"access": "AKIA[A-Z0-9]{16}", "hex": "[0-9a-f]{24}"}

_OPEN, _CUT, _CLOSE = "\u0001", "\u0002", "\u0003"
SPAN = "array<struct<start:bigint,end:bigint>>"


def spans(text: Column, rule: Rule) -> Column:
    """The spans of one rule, leftmost and without overlap."""
    marked = F.regexp_replace(text, rule.pattern, f"{_OPEN}$1{_CUT}$2{_CLOSE}")
    pieces = F.split(marked, _OPEN)
    none = F.array().cast(SPAN)
    head = F.length(F.element_at(pieces, 1)).cast("long")

    def step(state: Column, piece: Column) -> Column:
        match = F.substring_index(piece, _CLOSE, 1)
        secret = F.length(F.substring_index(match, _CUT, -1))
        start = state["at"]
        span = F.struct(start.alias("start"), (start + F.length(match) - 1).alias("end"))
        found = F.when(secret >= rule.least, F.array_append(state["found"], span)).otherwise(state["found"])
        return F.struct((start + F.length(piece) - 2).alias("at"), found.alias("found"))

    first = F.struct(head.alias("at"), none.alias("found"))
    return F.aggregate(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), first, step, lambda s: s["found"])


class Ledger:
    """Scanned contents in one folder: ``blob``, ``rule`` (kind and version), ``spans``."""

    def __init__(self, spark, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def read(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        schema = f"blob string, results array<struct<rule:string,spans:{SPAN}>>"
        if not files.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.folder)

    def scan(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> None:
        """Scan what the ledger lacks of these texts and rules, and append the findings."""
        keys = F.array(*[F.lit(r.key) for r in rules])
        known = self.read().groupBy("blob").agg(F.flatten(F.collect_list("results.rule")).alias("known"))
        # Copies end before the join, each task's own before the shuffle: a hot text is one row of each task.
        texts = docs.select(_blob(text_col).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).dropDuplicates(["blob"])
        todo = (
            texts.join(known, "blob", "left")
            .withColumn("todo", F.array_except(keys, F.coalesce("known", F.array().cast("array<string>"))))
            .where("size(todo) > 0").select("blob", "text", "todo")
        )
        clean = F.when(F.col("text").rlike("[\u0001-\u0003]"), F.translate("text", _OPEN + _CUT + _CLOSE, "~~~")).otherwise(F.col("text"))
        found = [
            F.when(
                F.array_contains("todo", r.key),
                F.struct(
                    F.lit(r.key).alias("rule"),
                    F.when(F.col("text").rlike(_NEEDED.get(r.kind, r.pattern)), spans(F.col("text"), r))
                    .otherwise(F.array().cast(SPAN)).alias("spans"),
                ),
            )
            for r in rules
        ]
        scanned = todo.withColumn("text", clean).select("blob", F.array_compact(F.array(*found)).alias("results"))
        with released_shuffles(self.spark):
            scanned.write.mode("append").parquet(self.folder)

    def findings(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``id_col`` and ``found``: kind, start and end of every span, by start and then by rule."""
        order = {r.key: i for i, r in enumerate(rules)}
        wanted = F.array(*[F.lit(k) for k in order])
        results = (
            self.read().groupBy("blob").agg(F.flatten(F.collect_list("results")).alias("results"))
            .withColumn("results", F.filter("results", lambda r: F.array_contains(wanted, r["rule"]) & (F.size(r["spans"]) > 0)))
            .where("size(results) > 0")
        )
        spread = F.flatten(
            F.transform(
                "results",
                lambda r: F.transform(
                    r["spans"],
                    lambda s: F.struct(
                        s["start"].alias("start"), F.array_position(wanted, r["rule"]).alias("place"), s["end"].alias("end"),
                        F.split_part(r["rule"], F.lit(":"), F.lit(1)).alias("kind"),
                    ),
                ),
            )
        )
        by_blob = results.select("blob", F.array_sort(spread).alias("found"))
        paths = docs.select(id_col, _blob(text_col).alias("blob"))
        return paths.join(by_blob, "blob", "left").select(id_col, "found")


def _blob(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)


def written(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.coalesce(
        F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","), F.lit("")
    )


def _count_of(found: str, kind: str) -> Column:
    return F.when(F.col(found).isNotNull(), F.size(F.filter(found, lambda s: s["kind"] == kind)))


def summarise(findings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of the base kinds, and all spans, of every path."""
    kinds = [r.kind for r in BASE]
    base = F.filter("found", lambda s: s["kind"].isin(kinds))
    counts = [F.coalesce(_count_of("found", k), F.lit(0)).cast("long").alias(f"n_{k}") for k in kinds]
    return findings.select(id_col, *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))
