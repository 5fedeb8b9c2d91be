"""Secret scans with an incremental ledger of blobs, in DataFrame functions only.

Every version of a text is a blob, named by its content. The ledger holds which (blob, rule, rule
version) were scanned and what was found. A scan takes any number of versions, finds the pairs that
the ledger lacks, scans each unseen blob once however many paths hold it, appends to the ledger, and
joins the findings back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from topictally.llm.rows import apart_from


@dataclass(frozen=True)
class Rule:
    """A pattern, the group that must be long enough, and the version of both."""

    name: str
    pattern: str
    least: int = 1
    group: int = 0
    version: int = 1


#: The rules every scan must contain, in this order.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8,
        2,
    ),
    # A run of these characters is matched whole, so its least length may stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)

#: Shapes that name their own issuer, so that plain prose never matches.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
)

RULES = BASE_RULES + MORE_RULES

#: What a text must contain for a rule to match at all; cheaper than the rule itself.
HINTS = {
    "assign": r"(?i:passw|secret|token|api_?key)",
    "access": r"AKIA[A-Z0-9]{12}",
    "hex": r"[0-9a-f]{32}",
}

SCANNED = "blob string, rule string, version int"
FOUND = "blob string, rule string, version int, start bigint, end bigint"


def matches(text: Column, rule: Rule) -> Column:
    """The rule's leftmost matches that do not overlap, as an array of (start, end) code points.

    Matches whose group is too short are dropped after matching; they still cover their place.
    """
    pattern = F.lit(rule.pattern)
    parts = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    steps = F.arrays_zip(
        F.transform(parts, F.char_length).alias("before"),
        F.transform(whole, F.char_length).alias("size"),
        F.transform(counted, F.char_length).alias("counted"),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("found"))

    def step(state: Column, item: Column) -> Column:
        begin = state["at"] + item["before"]
        end = begin + F.coalesce(item["size"], F.lit(0))
        here = F.array(F.struct(begin.alias("start"), end.alias("end")))
        kept = F.coalesce(item["counted"], F.lit(0)) >= rule.least
        return F.struct(
            end.alias("at"),
            F.when(kept, F.concat(state["found"], here)).otherwise(state["found"]).alias("found"),
        )

    return F.aggregate(steps, start, step, lambda state: state["found"])


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A ledger table, empty before its first write."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        columns = (column.split() for column in schema.split(", "))
        return spark.range(0).selectExpr(*(f"CAST(NULL AS {t}) AS {c}" for c, t in columns))
    return spark.read.schema(schema).parquet(folder)


def scan(
    versions: DataFrame,
    ledger: str,
    text: str = "text",
    key: str = "doc_id",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Bring the ledger up to date with ``versions`` and return their findings.

    ``ledger`` is a folder that all executors reach; a later scan with the same folder scans only
    blobs, rules and rule versions it has not met. A text may come any number of times: rows with
    the same text share one scan and all get its findings. A null text counts as empty and has no
    findings. Keys may be null or repeated; each row gives one row. Other columns are not read.

    Returns key, ``blob`` (content address) and ``spans``, an array of (start, rule, end) in the
    order of start, then of the rules; the array is empty where nothing was found.
    """
    spark = versions.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    paths = versions.select(
        F.col(key).alias("path"), F.sha2(body.cast("binary"), 256).alias("blob")
    )
    wanted = F.array([F.struct(F.lit(r.name), F.lit(r.version)) for r in rules])
    pairs = F.explode(wanted).alias("rule")
    known = _read(spark, f"{ledger}/scanned", SCANNED)
    # One path of each blob carries it to the scan.
    carriers = paths.groupBy("blob").agg(F.min("path").alias("path"))
    unseen = (
        carriers.select("blob", "path", pairs)
        .select("blob", "path", F.col("rule.col1").alias("rule"), F.col("rule.col2").alias("version"))
        .join(known, ["blob", "rule", "version"], "left_anti")
        .groupBy("blob", "path")
        .agg(F.collect_set(F.struct("rule", "version")).alias("todo"))
    )
    texts = versions.select(
        F.col(key).alias("own_path"), F.sha2(body.cast("binary"), 256).alias("blob"), body.alias("body")
    )
    suspects = texts.filter(F.col("body").rlike(_hint(rules)))
    same = (F.col("own_path").eqNullSafe(F.col("path"))) & (
        suspects["blob"] == unseen["blob"]
    )
    todo = suspects.join(unseen, same).select(unseen["blob"], "todo", "body")
    tries = F.array(
        [
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.version).alias("version"),
                F.when(
                    F.array_contains("todo.rule", r.name), matches(F.col("body"), r)
                ).alias("spans"),
            )
            for r in rules
        ]
    )
    found = (
        todo.select("blob", F.explode(tries).alias("try"))
        .select("blob", "try.rule", "try.version", F.explode("try.spans").alias("span"))
        .select("blob", "rule", "version", "span.start", "span.end")
    )
    found.write.mode("append").parquet(f"{ledger}/found")
    new = unseen.select("blob", F.explode("todo").alias("pair"))
    new.select("blob", "pair.rule", "pair.version").write.mode("append").parquet(f"{ledger}/scanned")
    return findings(paths, ledger, rules).withColumnRenamed("path", key)


def findings(paths: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Join the ledger's findings under the present rules back to (path, blob) rows."""
    spark = paths.sparkSession
    listed = [
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.lit(i).alias("place"))
        for i, r in enumerate(rules)
    ]
    # As many rows as rules.
    present = spark.range(1).select(F.inline(F.array(listed)))
    spans = (
        _read(spark, f"{ledger}/found", FOUND)
        .join(F.broadcast(present), ["rule", "version"])
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set(F.struct("start", "place", "rule", "end"))).alias("spans"))
    )
    spans.write.mode("overwrite").parquet(f"{ledger}/by-blob")
    by_blob = spark.read.parquet(f"{ledger}/by-blob")
    empty = F.array().cast("array<struct<start:bigint,place:int,rule:string,end:bigint>>")
    return paths.join(by_blob, "blob", "left").select(
        "path", "blob", F.coalesce("spans", empty).alias("spans")
    )


@apart_from("_blob", "_spans", "_clean")
def redact_documents(
    docs: DataFrame,
    ledger: str,
    text: str = "text",
    key: str = "doc_id",
    length: str | None = "n_chars",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """All rows and columns of ``docs``, with every finding in a text replaced by its rule's name.

    Where a text changes, the column ``length``, if there is one, gets its new number of code points.
    Texts that no rule can match pass by the join; null texts stay null.
    """
    scan(docs, ledger, text, key, rules)
    by_blob = docs.sparkSession.read.parquet(f"{ledger}/by-blob")
    by_blob = by_blob.select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans"))
    body = F.col(text).cast("string")
    suspect = F.coalesce(body.rlike(_hint(rules)), F.lit(False))
    named = docs.filter(suspect).withColumn("_blob", F.sha2(body.cast("binary"), 256))
    found = named.join(by_blob.hint("merge"), "_blob", "left")
    clean = F.when(F.col("_spans").isNull(), body).otherwise(redact(body, F.col("_spans")))
    found = found.withColumn("_clean", clean)
    changed = {text: F.col("_clean")}
    if length in docs.columns:
        size = F.char_length("_clean").cast(docs.schema[length].dataType)
        changed[length] = F.when(F.col("_spans").isNull(), F.col(length)).otherwise(size)
    found = found.withColumns(changed).select(*docs.columns)
    return docs.filter(~suspect).union(found)


def _hint(rules: tuple[Rule, ...]) -> str:
    return "|".join(HINTS.get(r.name, r.pattern) for r in rules)


def joined(spans: Column) -> Column:
    """Spans as ``rule:start:end``, joined by commas."""
    texts = F.transform(
        spans, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])
    )
    return F.array_join(texts, ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[rule]``, spans that overlap by the first one's."""

    def step(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]
        gap = F.substring(
            text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")
        )
        mark = F.concat(state["out"], gap, F.lit("["), s["rule"], F.lit("]"))
        return F.struct(
            F.greatest(state["at"], s["end"]).cast("bigint").alias("at"),
            F.when(inside, state["out"]).otherwise(mark).alias("out"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    rest = F.char_length(text)
    return F.aggregate(
        spans,
        start,
        step,
        lambda end: F.concat(end["out"], F.substring(text, (end["at"] + 1).cast("int"), rest)),
    )
