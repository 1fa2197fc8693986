"""Secret scan: fixed patterns and a randomness test battery, in DataFrame operations only.

Candidate strings are tested for looking like uniform random draws from the
alphabet of the encoding they seem to use: a chi-squared test of symbol
counts, a runs test of the alphabet's halves and a lag-one correlation. Their
p-values are joined by Fisher's method. Candidates are then rejected as not
random by the Benjamini-Hochberg step-up rule within their encoding and length
band, so that at most a share ``alpha`` of those rejected is expected to be
random after all; the others are reported. The step-up rule works on counts
per hundredth of a power of ten, which are few at any input size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstone.llm.common import Scratch

# Kinds in order of listing, their patterns and the group whose length counts.
KINDS = ("assign", "access", "hex", "random")
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",  # as AKIA[A-Z0-9]+ of 20 and more: runs are matched whole
    "hex": r"[0-9a-f]{24,}",  # as [0-9a-f]+ of 24 and more
    "random": r"[A-Za-z0-9+/_=-]{20,}",
}
# Alphabets by encoding.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
BANDS = (32, 64)  # lengths at which a new band begins
BINS = 100  # bins per power of ten of a p-value
LEAST = 1e-290


def matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, k, kind, start, end, value) of all leftmost non-overlapping matches, in code points.

    A match starts after the pieces and matches before it. One row is exploded per match, none per text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = []
    for number, kind in enumerate(KINDS):
        pattern = F.lit(PATTERNS[kind])
        found = F.arrays_zip(
            F.transform(F.split(text, PATTERNS[kind], -1), F.length).alias("gap"),
            F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
            F.regexp_extract_all(text, pattern, F.lit(1 if kind == "assign" else 0)).alias("value"),
        )
        empty = F.array().cast("array<struct<gap:int,match:string,value:string>>")
        kinds.append(F.struct(F.lit(number).alias("kind"), F.when(text.rlike(PATTERNS[kind]), found).otherwise(empty).alias("found")))
    each = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h")).alias("k"),
        F.filter(F.array(*kinds), lambda x: F.size(x["found"]) > 0).alias("found"),
    )
    each = each.select("rid", "k", F.explode("found").alias("x"))
    each = each.select("rid", "k", "x.kind", F.posexplode("x.found").alias("i", "m")).filter("m.match IS NOT NULL")
    before = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.length("m.match")).over(before)
    return each.select(
        "rid", "k", "kind", (end - F.length("m.match")).alias("start"), end.alias("end"), F.col("m.value").alias("value")
    )


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, to a few percent."""
    half = F.lit(0.5) * F.exp(F.lit(-0.717) * F.abs(z) - F.lit(0.416) * z * z)
    return F.when(z >= 0, half).otherwise(1 - half)


def battery(candidates: DataFrame, value: str = "value") -> DataFrame:
    """candidates with ``encoding``, ``p_uniform``, ``p_runs``, ``p_serial`` and Fisher's combined ``p_random``."""
    raw = F.regexp_replace(value, "=+$", "")
    encoding = (
        F.when(raw.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(raw.rlike("^[A-Z2-7]+$"), "base32")
        .when(raw.rlike("^[A-Za-z0-9]+$"), "alnum").when(raw.rlike("[-_]"), "base64url").otherwise("base64")
    )
    alphabet = F.create_map(*[F.lit(x) for item in ALPHABETS.items() for x in item])
    rows = candidates.withColumn("encoding", encoding)
    symbols = F.when(F.col("encoding") == "hex", F.lower(raw)).otherwise(raw)
    rows = rows.withColumn("_s", F.split(symbols, "")).withColumn("_a", alphabet[F.col("encoding")])
    rows = rows.withColumn("_x", F.transform("_s", lambda c: F.instr(F.col("_a"), c).cast("double") - 1))
    rows = rows.withColumn("_n", F.size("_x").cast("double")).withColumn("_k", F.length("_a").cast("double"))
    total = lambda array: F.aggregate(array, F.lit(0.0), lambda s, x: s + x)
    squares = total(F.transform(F.array_distinct("_x"), lambda v: F.pow(F.size(F.filter("_x", lambda y: y == v)).cast("double"), F.lit(2.0))))
    chi = squares * F.col("_k") / F.col("_n") - F.col("_n")
    z_chi = (chi - (F.col("_k") - 1)) / F.sqrt(2 * (F.col("_k") - 1) * (F.col("_n") - 1) / F.col("_n"))
    tail, head = F.expr("slice(_x, 2, size(_x) - 1)"), F.expr("slice(_x, 1, size(_x) - 1)")
    turns = total(F.zip_with(head, tail, lambda a, b: ((a >= F.col("_k") / 2) != (b >= F.col("_k") / 2)).cast("double")))
    z_runs = (turns - (F.col("_n") - 1) / 2) / F.sqrt((F.col("_n") - 1) / 4)
    mean = total("_x") / F.col("_n")
    rows = rows.withColumn("_m", mean)
    spread = total(F.transform("_x", lambda v: (v - F.col("_m")) * (v - F.col("_m"))))
    lagged = total(F.zip_with(head, tail, lambda a, b: (a - F.col("_m")) * (b - F.col("_m"))))
    z_serial = F.when(spread > 0, lagged / spread * F.sqrt("_n")).otherwise(F.sqrt("_n"))
    two_sided = lambda z: F.least(2 * upper_tail(F.abs(z)), F.lit(1.0))
    bound = lambda p: F.greatest(p, F.lit(LEAST))
    rows = (
        rows.withColumn("p_uniform", bound(upper_tail(z_chi)))
        .withColumn("p_runs", bound(two_sided(z_runs)))
        .withColumn("p_serial", bound(two_sided(z_serial)))
    )
    y = -(F.log("p_uniform") + F.log("p_runs") + F.log("p_serial"))
    return rows.withColumn("p_random", bound(F.exp(-y) * (1 + y + y * y / 2))).drop("_s", "_a", "_x", "_n", "_k", "_m")


def not_rejected(tested: DataFrame, alpha: float) -> DataFrame:
    """The rows that the step-up rule leaves as random, judged within encoding and length band."""
    band = F.lit(0)
    for edge in BANDS:
        band = band + (F.length("value") >= edge).cast("int")
    rows = tested.withColumn("band", band).withColumn("bin", F.floor(-F.log10("p_random") * BINS).cast("int"))
    counts = rows.groupBy("encoding", "band", "bin").agg(F.count("*").alias("c"))
    group = Window.partitionBy("encoding", "band")
    smaller = F.sum("c").over(group.orderBy(F.desc("bin")))
    passes = F.pow(F.lit(10.0), -F.col("bin") / F.lit(float(BINS))) <= F.lit(alpha) * F.col("i") / F.col("m")
    least = (
        counts.withColumn("i", smaller).withColumn("m", F.sum("c").over(group))
        .filter(passes).groupBy("encoding", "band").agg(F.min("bin").alias("from"))
    )  # at most one row for each encoding and band
    return rows.join(F.broadcast(least), ["encoding", "band"], "left").filter("from IS NULL OR bin < from").drop("from", "bin")


def secrets(docs: DataFrame, alpha: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id and ``spans``, an array of (start, kind, end) in code points, end exclusive.

    ``kind`` counts in KINDS. Fixed patterns come first and are all kept; the battery adds spans of kind
    ``random``, also where a fixed one lies. Null text has no spans, rows equal in id and text get the same,
    null ids are kept, empty tables give no rows, and other columns are not read. Texts of any length are searched
    whole; a long text is one row of its matches.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    found = scratch.store(matches(docs, id_col, text_col), "matches")
    base = found.filter((F.col("kind") != 0) & (F.col("kind") != 3) | (F.col("kind") == 0) & (F.length("value") >= 6))
    random = not_rejected(battery(found.filter("kind = 3")), alpha)
    spans = base.select("k", "start", "kind", "end").unionByName(random.select("k", "start", "kind", "end"))
    listed = spans.groupBy("k").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("spans"))
    rows = docs.select(
        F.col(id_col), F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h")).alias("k")
    ).join(listed, "k", "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.select(id_col, F.coalesce("spans", none).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")
