"""Secret scans: fixed patterns, and a battery of randomness tests on long runs.

Fixed patterns give the base spans. Runs of 20 and more characters of base64 are
tested for randomness within the encoding that their characters suggest (hex,
base32, base36, base62, base64, base36 with dashes). Of every run that holds
separators, such as a key behind a path or a prefix, the parts of 20 and more
characters between its slashes, between its dashes and between both are tested
too, whatever the whole run's verdict. The tests are chi-squared uniformity over the alphabet, the
number of runs above and below the alphabet's middle, and the serial correlation
of neighbours. The least of the three two-sided p-values, times three, is the
run's: a key's is spread evenly, long enough text has a very small one.

What is claimed is that a run is no text, so the control is on that side. How
often runs of text come out as random as a run does was measured for classes of length
(``TEXT_TAIL``) and is the claim's p-value. Benjamini and Hochberg's procedure
within each class of length then claims as many runs as keep the expected share of text
among the claimed within ``RATE``: few and only sure ones of 20 characters where
most runs are names, nearly all keys of 48 characters everywhere. The claimed
are spans of kind ``random``.

Everything is a DataFrame expression. P-values are counted in steps of a tenth
of their logarithm, rounded up, so the procedure needs the counts of a bounded
table, not a sort of all candidates. Texts are read once: the matches are stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from instrel.llm.common import stored

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The same matches as of AKIA[A-Z0-9]+ and [0-9a-f]+ with at least 20 and 24 characters.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
RUN = "[A-Za-z0-9+/_-]{20,}={0,2}"
ANY = rf"(?i:password|passwd|secret|token|api_?key)|{ACCESS}|{HEX}|{RUN}"
LEAST_VALUE = 6
#: Share of text expected among the runs that are claimed, at most.
RATE = 0.05
STEPS = 400
#: Fixed values, measured on 350,000 runs of words of the test data with numbers among them, joined by dashes, underscores, slashes or
#: nothing: the share of runs of text, by their least length, whose step is at most that of ``TAIL_STEPS``; one run more is counted in each.
TAIL_STEPS = (0, 5, 10, 15, 20, 25, 30, 40, 50, 60, 80, 100)
TEXT_TAIL = {
    20: (0.0078, 0.021, 0.037, 0.059, 0.08, 0.11, 0.13, 0.19, 0.26, 0.29, 0.41, 0.49),
    24: (0.0011, 0.0028, 0.0065, 0.011, 0.019, 0.026, 0.037, 0.062, 0.09, 0.12, 0.18, 0.25),
    32: (9e-05, 0.00011, 0.00019, 0.00035, 0.00065, 0.0011, 0.0015, 0.0033, 0.0061, 0.01, 0.019, 0.032),
    48: (1.5e-05, 1.5e-05, 1.5e-05, 1.5e-05, 1.5e-05, 1.5e-05, 1.5e-05, 1.5e-05, 1.5e-05, 3.1e-05, 0.00022, 0.00052),
    64: (9.5e-06, 9.5e-06, 9.5e-06, 9.5e-06, 9.5e-06, 9.5e-06, 9.5e-06, 9.5e-06, 9.5e-06, 1.9e-05, 3.8e-05, 8.5e-05),
}

#: Parts of a run that are tested beside it: between slashes, between dashes, between both.
PARTS = ("[A-Za-z0-9_-]{20,}", "[A-Za-z0-9+/]{20,}", "[A-Za-z0-9]{20,}")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings in the order in which they are inferred: name, what a run must match, alphabet.
ENCODINGS = [
    ("hex", "^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", _DIGITS + "abcdef"),
    ("HEX", "^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("base32", "^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", _UPPER + "234567"),
    ("base36", "^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", _DIGITS + _LOWER),
    ("BASE36", "^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$", _DIGITS + _UPPER),
    ("base62", "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER),
    ("base64", "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
]
#: For what has none of these. (Slashes and one case make no encoding: in so wide an alphabet paths of short names pass for keys.)
DASHED = [
    ("dashed base36", "^(?=.*[0-9])(?=.*[a-z])[0-9a-z_-]+$", _DIGITS + _LOWER + "-_"),
    ("dashed BASE36", "^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z_-]+$", _DIGITS + _UPPER + "-_"),
]


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """``kind, nr, gap, value`` of every leftmost match without overlap; ``gap``: characters since the match before."""
    values = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(values))
    return F.transform(
        F.arrays_zip(gaps.alias("gap"), values.alias("value")),
        lambda m, nr: F.struct(F.lit(kind).alias("kind"), nr.alias("nr"), F.length(m["gap"]).alias("gap"), m["value"].alias("value")))


def _two_sided(z: Column) -> Column:
    """Probability of a normal variate at least as far from 0: the polynomial of Abramowitz and Stegun, 7.1.26."""
    x = F.abs(z) / F.lit(2.0**0.5)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), F.greatest(F.lit(1e-300), poly * F.exp(-x * x)))


def _encoding(value: Column, encodings: list) -> Column:
    body = F.rtrim(value, F.lit("="))
    return F.coalesce(*(F.when(body.rlike(pattern), F.lit(i)) for i, (_, pattern, _) in enumerate(encodings)))


def with_parts(runs: DataFrame) -> DataFrame:
    """``doc, start, end, value, run`` of ``runs`` and of their parts; ``run``: where the run starts."""
    columns = ["doc", "start", "end", "value", "run"]
    whole = runs.withColumn("run", F.col("start")).select(*columns)
    parts = whole.where(F.col("value").rlike("[+/_-]")).select("doc", "run", F.explode(F.concat(
        *(_matches(F.col("value"), pattern, kind) for kind, pattern in enumerate(PARTS)))).alias("m")).select("doc", "run", "m.*")
    so_far = Window.partitionBy("doc", "run", "kind").orderBy("nr").rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.withColumn("end", F.col("run") + F.sum(F.col("gap") + F.length("value")).over(so_far)).withColumn(
        "start", F.col("end") - F.length("value"))
    # A part may be found by several patterns, or be the whole run.
    return placed.select(*columns).unionByName(whole).dropDuplicates(["doc", "start", "end"])


def outermost(found: DataFrame) -> DataFrame:
    """``found`` without spans that lie in another of the same run."""
    before = Window.partitionBy("doc", "run").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("reach", F.max("end").over(before)).where(F.col("reach").isNull() | (F.col("end") > F.col("reach"))).drop("reach")


def test_runs(runs: DataFrame) -> DataFrame:
    """``runs`` (with a column ``value``) that have an encoding, with ``p`` and ``length``."""
    body = F.rtrim(F.col("value"), F.lit("="))
    encodings = ENCODINGS + DASHED
    encoding = _encoding(F.col("value"), encodings)
    coded = runs.withColumn("body", body).withColumn("encoding", encoding).where("encoding is not null")
    pick = lambda of: F.element_at(F.array(*(of(alphabet) for _, _, alphabet in encodings)), F.col("encoding") + 1)
    bits = F.coalesce(*(
        F.when(F.col("encoding") == i, F.translate("body", a, "0" * (len(a) // 2) + "1" * (len(a) - len(a) // 2)))
        for i, (_, _, a) in enumerate(encodings)))
    sized = coded.select(
        "*", pick(F.lit).alias("alphabet"), bits.alias("bits"), F.length("body").cast("double").alias("n"))
    k = F.length("alphabet").cast("double")
    squares = F.aggregate(
        F.transform(F.array_distinct(F.split("body", "")), lambda c: F.length(F.col("body")) - F.length(F.replace(F.col("body"), c, F.lit("")))),
        F.lit(0.0), lambda so_far, count: so_far + count.cast("double") * count)
    ones = F.length(F.replace("bits", F.lit("0"), F.lit(""))).cast("double")
    turns = (2 * F.length("bits") - F.length(F.replace("bits", F.lit("01"), F.lit(""))) - F.length(F.replace("bits", F.lit("10"), F.lit("")))) / 2
    values = F.transform(F.split("body", ""), lambda c: F.instr(F.col("alphabet"), c).cast("double"))
    measured = sized.select(
        "*", k.alias("k"), squares.alias("squares"), ones.alias("ones"), (turns + 1).alias("turns"), values.alias("values"))
    mean = F.aggregate("values", F.lit(0.0), lambda so_far, x: so_far + x) / F.col("n")
    centred = measured.withColumn("mean", mean).withColumn("values", F.transform("values", lambda x: x - F.col("mean")))
    power = F.aggregate("values", F.lit(0.0), lambda so_far, x: so_far + x * x)
    lagged = F.aggregate(
        F.zip_with("values", F.slice("values", 2, F.size("values")), lambda x, y: x * F.coalesce(y, F.lit(0.0))),
        F.lit(0.0), lambda so_far, x: so_far + x)
    n, k, ones = F.col("n"), F.col("k"), F.col("ones")
    chi = F.col("squares") * k / n - n
    z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    expected = 2 * ones * (n - ones) / n + 1
    z_runs = (F.col("turns") - expected) / F.sqrt((expected - 1) * (expected - 2) / (n - 1))
    z_serial = (lagged / power + 1 / n) * F.sqrt(n)
    one_sided = F.col("ones").isin(0.0) | (F.col("ones") == n)
    p = F.least(
        _two_sided(z_chi), F.when(one_sided | (expected <= 2), F.lit(1e-300)).otherwise(_two_sided(z_runs)),
        F.when(power <= 0, F.lit(1e-300)).otherwise(_two_sided(z_serial)))
    return centred.select(*runs.columns, F.least(F.lit(1.0), 3 * p).alias("p"), F.col("n").cast("int").alias("length"))


def text_tail(least: Column, step: Column) -> Column:
    """How often a run of text of this class of length has this step or a smaller one, at most."""
    found = F.lit(1.0)
    for length, tail in TEXT_TAIL.items():
        own = F.lit(1.0)
        for upper, share in reversed(list(zip(TAIL_STEPS, tail, strict=True))):
            own = F.when(step <= upper, F.lit(share)).otherwise(own)
        found = F.when(least == length, own).otherwise(found)
    return found


def random_runs(tested: DataFrame, rate: float = RATE) -> DataFrame:
    """The tested runs that are claimed to be no text; the table of counts has ``STEPS`` + 1 rows for each class of length at most."""
    least = F.lit(min(TEXT_TAIL))
    for length in sorted(TEXT_TAIL):
        least = F.when(F.col("length") >= length, F.lit(length)).otherwise(least)
    classed = tested.withColumn("size", least).withColumn(
        "step", F.least(F.lit(STEPS), F.floor(-F.log("p") * 10 + 1e-9).cast("int")))
    counts = classed.groupBy("size", "step").agg(F.count(F.lit(1)).alias("runs"))
    rising = Window.partitionBy("size").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select(
        "size", "step", F.sum("runs").over(rising).alias("rank"), F.sum("runs").over(Window.partitionBy("size")).alias("all"))
    claimed = text_tail(F.col("size"), F.col("step")) <= rate * F.col("rank") / F.col("all")
    limits = ranked.where(claimed).groupBy("size").agg(F.max("step").alias("limit"))
    # One row for each class of length.
    return classed.join(F.broadcast(limits), "size").where(F.col("step") <= F.col("limit")).drop("size", "step", "limit")


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """``doc, kind, start, end``: spans in code points, ``end`` exclusive; ``doc`` holds the id and a hash of the text.

    Texts without any candidate are left after one regular expression; the matches of the others are stored. Null texts have no spans; rows that repeat
    a document give its spans once.
    """
    rows = docs.select(
        F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash")).alias("doc"), F.col(text_col).alias("text"))
    text = F.col("text")
    found = rows.where(text.rlike(ANY)).select("doc", F.explode(F.concat(
        *(_matches(text, pattern, kind) for kind, pattern in enumerate((ASSIGN, ACCESS, HEX, RUN))))).alias("m")).select("doc", "m.*")
    once = found.dropDuplicates(["doc", "kind", "nr"])
    so_far = Window.partitionBy("doc", "kind").orderBy("nr").rowsBetween(Window.unboundedPreceding, 0)
    placed = stored(once.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(so_far)).select(
        "doc", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value"), "matches")
    base = placed.where((F.col("kind") < 3) & (
        (F.col("kind") > 0) | (F.length(F.regexp_extract("value", ASSIGN, 2)) >= LEAST_VALUE)))
    random = outermost(random_runs(test_runs(with_parts(placed.where(F.col("kind") == KINDS.index("random")))), rate)).withColumn(
        "kind", F.lit(KINDS.index("random")))
    columns = ["doc", "kind", "start", "end"]
    return base.select(*columns).unionByName(random.select(*columns))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """``doc_id, spans`` of every row; ``spans``: array of ``start, kind, end`` in order, ``kind`` numbering ``KINDS``.

    Null and empty texts have no spans. Repeated rows repeat.
    """
    lists = find_spans(docs, id_col, text_col, rate).groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    keys = docs.select(F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash")).alias("doc"))
    none = F.array().cast(lists.schema["spans"].dataType)
    return keys.join(lists, "doc", "left").select("doc.doc_id", F.coalesce("spans", none).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts by kind and the spans as text."""
    base = F.filter("spans", lambda s: s["kind"] < 3)
    spelled = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return scanned.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with every span, overlapping ones as one, replaced by ``mark`` in the text; nothing else changes."""
    before = Window.partitionBy("doc").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = find_spans(docs, id_col, text_col).withColumn("reach", F.max("end").over(before))
    joined = spans.withColumn("nr", F.sum(F.when(F.col("reach").isNull() | (F.col("start") > F.col("reach")), 1).otherwise(0)).over(
        Window.partitionBy("doc").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)))
    whole = joined.groupBy("doc", "nr").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = whole.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts")).select(
        F.col("doc.doc_id").alias("cut_id"), F.col("doc.text_hash").alias("cut_hash"), "cuts")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    starts, ends = F.transform("cuts", lambda s: s["start"]), F.transform("cuts", lambda s: s["end"])
    pieces = F.zip_with(
        F.concat(F.array(F.lit(0).cast("bigint")), ends), F.concat(starts, F.array(F.length("text").cast("bigint"))),
        lambda a, b: F.substring(F.col("text"), a.cast("int") + 1, (b - a).cast("int")))
    out = rows.join(cuts, F.col("id").eqNullSafe(F.col("cut_id")) & (F.xxhash64("text") == F.col("cut_hash")), "left")
    clean = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.array_join(pieces, mark)).alias(text_col)
    return out.select(*(clean if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
