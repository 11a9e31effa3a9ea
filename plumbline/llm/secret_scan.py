"""Secret scan over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text. The
ledger records which (blob, rule version) pairs were scanned and what was
found; only pairs it does not know are scanned, each blob once however many
paths hold it, and findings are joined back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import whole_text


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (leftmost, not overlapping), of which those with
    ``least`` or more code points in group ``group`` count. A changed rule
    needs a new ``version``: only then are known blobs scanned again."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.version}"


# A run of hex digits, or of key letters, that is too short ends where a long
# enough one cannot begin inside it, so its length may stand in the pattern.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("basic", r"(?:https?|ftp|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\s:/@]+:[^\s:/@]{3,}@"),
)
RULES = BASE + MORE

# Matches of one text are summed up in runs of this many, see ``spans``.
RUN = 128

FINDINGS = "sha binary, rules array<string>, spans array<struct<start:bigint,end:bigint,kind:string,rule:string>>"


def spans(text: str, rule: Rule) -> Column:
    """Spans of a rule in a text column, in code points, end exclusive.

    The text between matches comes from a split by the same pattern, so the
    lengths of gaps and matches in turn give every position. A fold copies the
    list that it extends, so it goes over runs of ``RUN`` matches, and the
    starts of the runs come from a fold over their sums.
    """
    gaps = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(F.col(text), F.lit(rule.pattern), F.lit(0))
    inner = F.regexp_extract_all(F.col(text), F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    piece = F.transform(
        F.arrays_zip(gaps.alias("gap"), found.alias("match"), inner.alias("inner")),
        lambda p: F.struct(
            F.length(p["gap"]).cast("bigint").alias("gap"),
            F.coalesce(F.length(p["match"]), F.lit(0)).cast("bigint").alias("size"),
            (F.length(p["inner"]) >= max(1, rule.least)).alias("counts"),
        ),
    )
    span = "struct<start:bigint,end:bigint,kind:string,rule:string>"
    none = F.array().cast(f"array<{span}>")
    zero = F.lit(0).cast("bigint")

    def placed(start: Column, run: Column) -> Column:
        return F.aggregate(
            run,
            F.struct(start.alias("at"), none.alias("spans")),
            lambda a, p: F.struct(
                (a["at"] + p["gap"] + p["size"]).alias("at"),
                F.when(
                    p["counts"],
                    F.concat(a["spans"], F.array(F.struct(
                        (a["at"] + p["gap"]).alias("start"),
                        (a["at"] + p["gap"] + p["size"]).alias("end"),
                        F.lit(rule.kind).alias("kind"),
                        F.lit(rule.name).alias("rule"),
                    ))),
                ).otherwise(a["spans"]).alias("spans"),
            ),
            lambda a: a["spans"],
        )

    def in_runs(pieces: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / RUN).cast("int")), lambda k: F.slice(pieces, k * RUN + 1, RUN))
        sums = F.transform(runs, lambda r: F.aggregate(r, zero, lambda a, p: a + p["gap"] + p["size"]))
        starts = F.aggregate(
            sums, F.array(zero), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n))
        )
        return F.flatten(F.zip_with(F.slice(starts, F.lit(1), F.size(runs)), runs, placed))

    # A lambda's argument is worked out once, however often it is used.
    out = F.element_at(F.transform(F.array(piece), in_runs), 1)
    return F.when(F.col(text).rlike(rule.pattern), out).otherwise(none)


def digest(text: str) -> Column:
    return F.unhex(F.sha2(F.encode(whole_text(text), "UTF-8"), 256))


def update_ledger(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> int:
    """Scan what the ledger does not know of ``versions`` (path, text) and
    append it; returns the number of blobs scanned.

    One text per blob is picked by a join with the smallest path per digest:
    the digests are hashed, so no key is hot, and a blob with many copies is
    combined in the map tasks. The ledger is a Parquet table of (sha, rules,
    spans); an update that fails leaves nothing behind, and can be repeated.
    """
    spark = versions.sparkSession
    hashed = versions.select("path", digest("text").alias("sha"))
    names = [r.name for r in rules]
    blobs = hashed.groupBy("sha").agg(F.min("path").alias("path"))
    known = _ledger(spark, ledger)
    if known is None:
        todo = blobs.withColumn("todo", F.array(*map(F.lit, names)))
    else:
        seen = known.select("sha", F.explode("rules").alias("rule")).where(F.col("rule").isin(names))
        seen = seen.groupBy("sha").agg(F.collect_set("rule").alias("seen"))
        unseen = F.array_except(F.array(*map(F.lit, names)), F.coalesce("seen", F.array().cast("array<string>")))
        todo = blobs.join(seen, "sha", "left").select("sha", "path", unseen.alias("todo"))
    todo = todo.where(F.size("todo") > 0)
    texts = versions.select("path", whole_text().alias("text")).withColumn("sha", digest("text"))
    # Paths are null-safe by their blob: a null path is the least of its digest only when it is alone.
    picked = texts.join(todo.hint("shuffle_hash"), (texts.sha == todo.sha) & texts.path.eqNullSafe(todo.path)).select(
        todo.sha, "todo", "text"
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint,kind:string,rule:string>>")
    found = [F.when(F.array_contains("todo", r.name), spans("text", r)).otherwise(empty) for r in rules]
    scanned = picked.select("sha", F.col("todo").alias("rules"), F.concat(*found).alias("spans")).dropDuplicates(["sha"])
    before = 0 if known is None else known.count()
    scanned.write.mode("append").parquet(ledger)
    return _ledger(spark, ledger).count() - before


def _ledger(spark, path: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(FINDINGS).parquet(path)


def findings(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, sha, spans) of every row of ``versions``, from the ledger.

    Spans are ordered by start, then by the order of the rules, then end.
    Rows with null text count as empty. Repeated rows come repeatedly.
    """
    known = _ledger(versions.sparkSession, ledger)
    wanted = F.filter("spans", lambda s: s["rule"].isin([r.name for r in rules]))
    per_blob = known.select("sha", wanted.alias("spans")).groupBy("sha").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    ordered = F.transform(
        F.array_sort(F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")
        ))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    hashed = versions.select("path", digest("text").alias("sha"))
    return hashed.join(per_blob.select("sha", ordered.alias("spans")), "sha", "left")


def listed(spans: str | Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
