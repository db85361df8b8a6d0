"""Secret scan with an incremental blob ledger.

Every version of a text is addressed by its SHA-256.  The ledger holds which (blob, rule
version) pairs have been scanned and what they gave; a run scans each blob once, however many
paths hold it, and only with rules whose version the ledger has not seen for it.  Findings are
joined back to all paths by the blob's address.

A screen (one alternation of the rules' openings) runs where the text is read; only blobs that
it passes are moved and scanned, so the text of most documents never leaves its task.  Equal
blobs collapse before the shuffle.  Positions come from the pieces between matches, summed
with a window per blob and rule, so a text with very many matches stays linear.

Defined cases: null text is the empty blob, which has no findings; repeated rows and equal
texts share one scan; an empty table gives an empty result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; those whose ``group`` has fewer than
    ``least`` characters are dropped."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    screen: str = ""
    version: str = "1"
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: fixed values: the base kinds in their order, then the further ones of this scan
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2,
         r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""", base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 20, screen=r"AKIA[A-Z0-9]{16}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", 24, screen=r"[0-9a-f]{24}", base=True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", screen=r"-----BEGIN [A-Z ]*PRIVATE KEY"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", screen=r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", screen=r"eyJ[A-Za-z0-9_-]{8,}\.eyJ"),
)
LEDGER = "blob string, rule string, kind string, start long, stop long"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def scan_new(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
             text_col: str = "text") -> DataFrame:
    """Ledger rows of the unseen (blob, rule version) pairs that ``docs`` bring: findings with
    start and stop (code points, exclusive), and one row with null kind per scanned pair without."""
    screen = "|".join(r.screen for r in rules)
    texts = docs.select(blob_of(F.col(text_col)).alias("blob"), F.col(text_col).cast("string").alias("_t"))
    blobs = (texts.select("blob", F.when(F.col("_t").rlike(screen), F.col("_t")).alias("_t"))
             .groupBy("blob").agg(F.max("_t").alias("_t")) if ledger is not None else
             texts.where(F.col("_t").rlike(screen)).groupBy("blob").agg(F.max("_t").alias("_t")))
    todo = F.array(*(F.lit(r.key) for r in rules))
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("_seen"))
        blobs = blobs.join(seen, "blob", "left")
        todo = F.array_except(todo, F.coalesce("_seen", F.array().cast("array<string>")))
    blobs = blobs.withColumn("_todo", todo)
    per_rule = []
    for r in rules:
        all_ = F.regexp_extract_all("_t", F.lit(r.pattern), F.lit(0))
        part = F.regexp_extract_all("_t", F.lit(r.pattern), F.lit(r.group)) if r.group else all_
        per_rule.append(F.when(F.array_contains("_todo", r.key) & F.col("_t").rlike(r.screen), F.struct(
            F.lit(r.key).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"),
            F.transform(F.arrays_zip(F.split("_t", r.pattern, -1).alias("gap"), all_.alias("hit"), part.alias("val")),
                        lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"),
                                           F.length(x["val"]).alias("val"))).alias("m"))))
    found = (blobs.select("blob", F.explode(F.filter(F.array(*per_rule), lambda x: x.isNotNull())).alias("r"))
             .select("blob", "r.rule", "r.kind", "r.least", F.posexplode("r.m").alias("i", "m")))
    before = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("m.gap") + F.coalesce("m.hit", F.lit(0))).over(before)
    spans = (found.withColumn("stop", stop.cast("long")).where(F.col("m.val") >= F.col("least"))
             .select("blob", "rule", "kind", (F.col("stop") - F.col("m.hit")).cast("long").alias("start"), "stop"))
    if ledger is None:
        return spans
    done = blobs.select("blob", F.explode("_todo").alias("rule"), F.lit(None).cast("string").alias("kind"),
                        F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("stop"))
    return spans.unionByName(done)


def update(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The ledger after ``docs``: old rows and the new pairs' rows."""
    return ledger.unionByName(scan_new(docs, ledger, rules, text_col))


def report(docs: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Findings joined back to every path: counts per base kind, digest of the base spans, spans."""
    order = {r.kind: i for i, r in enumerate(rules)}
    base = [r.kind for r in rules if r.base]
    rank = F.element_at(F.create_map(*(F.lit(x) for kv in order.items() for x in kv)), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), F.concat_ws(":", "kind", "start", "stop").alias("s"))
    text = lambda c: F.concat_ws(",", F.transform(F.array_sort(F.collect_list(c)), lambda x: x["s"]))
    per_blob = findings.where(F.col("kind").isNotNull()).groupBy("blob").agg(
        *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in base),
        text(F.when(F.col("kind").isin(base), span)).alias("_base"), text(span).alias("spans"))
    paths = docs.select(F.col(id_col), blob_of(F.col(text_col)).alias("blob"))
    return paths.join(per_blob, "blob", "left").select(
        id_col, *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(F.coalesce("_base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), "blob")
