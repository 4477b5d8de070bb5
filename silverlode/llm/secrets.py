"""Secrets in texts: fixed patterns, and tokens that a battery of randomness tests cannot tell from random."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.common import stored

# Fixed values of the contract, in the order of kinds: pattern, group that is measured, least length.
PATTERNS = (
    ("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)
# The same matches without the many short ones: greedy runs of a class that are long enough begin where plain runs begin.
LONG_RUNS = {"access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
KINDS = (*(p[0] for p in PATTERNS), "random")
RANDOM = len(PATTERNS)

# Runs of characters of the usual encodings; the tests decide which of them are random.
CANDIDATE = "[A-Za-z0-9+/_-]{20,}={0,2}"
# (name, whole token, symbols in order of their value); the first that fits is inferred.
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "^[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", "^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
# Equal cells of an alphabet for the chi-squared test; a token of 20 characters has several expected in each.
CELLS = 4
# A token carries at least so many bits, were it random.
MIN_BITS = 80.0
# Share of real secrets among those that the tests dismiss, at most.
FALSE_DISCOVERIES = 0.01
# Steps of p-values for the control: twenty to a power of ten.
STEPS, SMALLEST = 20, 1e-300
MARK = "[SECRET]"


def _spans(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """Spans (start, kind, end) of leftmost matches of which the group is long enough; positions in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,length:int>>")
    rows = F.zip_with(
        F.zip_with(matches, measured, lambda m, g: F.struct(F.length(m).alias("size"), F.length(g).alias("length"))),
        between,
        lambda m, gap: F.struct(m["size"].alias("size"), m["length"].alias("length"), F.length(gap).alias("gap")),
    )
    # The piece after the last match has no match of its own.
    rows = F.filter(rows, lambda r: r["size"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    walked = F.aggregate(
        rows,
        start,
        lambda state, r: F.struct(
            (state["at"] + r["gap"] + r["size"]).alias("at"),
            F.array_append(
                state["found"],
                F.struct(
                    (state["at"] + r["gap"]).alias("start"),
                    F.lit(kind).alias("kind"),
                    (state["at"] + r["gap"] + r["size"]).alias("end"),
                    r["length"].alias("length"),
                ),
            ).alias("found"),
        ),
    )
    found = F.filter(walked["found"], lambda s: s["length"] >= least)
    found = F.transform(found, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def _upper_tail(z: Column) -> Column:
    """Probability above z under the normal distribution, to about 2e-4."""
    bounded = F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))
    return 1 / (1 + F.exp(1.5976 * bounded + 0.07056 * bounded * bounded * bounded))


def _chi_squared_tail(chi: Column, free: Column) -> Column:
    """Probability above a value of chi-squared, by the normal distribution of its cube root."""
    return _upper_tail((F.pow(chi / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)))


def _class_sizes(symbols: str) -> list[int]:
    """How many symbols of an alphabet are digits, small letters, capitals and others."""
    tests = (str.isdigit, str.islower, str.isupper, lambda c: not c.isalnum())
    return [sum(map(test, symbols)) for test in tests]


def _symbols(token: Column) -> tuple[Column, Column, Column]:
    """Values of the characters of a token in its inferred encoding, the size of that alphabet (null if none fits) and of its classes."""
    body = F.rtrim(token, F.lit("="))

    def places(symbols: str) -> Column:
        return F.transform(F.split(body, ""), lambda c: F.instr(F.lit(symbols), c) - 1)

    values = F.lit(None).cast("array<int>")
    size = F.lit(None).cast("int")
    classes = F.lit(None).cast("array<int>")
    for _, whole, symbols in reversed(ENCODINGS):
        fits = F.rlike(body, F.lit(whole))
        values = F.when(fits, places(symbols)).otherwise(values)
        size = F.when(fits, F.lit(len(symbols))).otherwise(size)
        classes = F.when(fits, F.array(*map(F.lit, _class_sizes(symbols)))).otherwise(classes)
    return values, size, classes


def randomness(token: Column) -> Column:
    """Struct of ``p`` (chance that a random token of its encoding looks this odd) and ``bits`` (its length times bits a symbol).

    Four tests share one bound: chi-squared uniformity over equal cells of the alphabet and
    over its classes (digits, small letters, capitals, others), the number of runs above
    and below its middle, and the correlation of each symbol with the next. Tokens without letters or without digits get p = 0.
    """
    values, size, classes = _symbols(token)
    seen = F.array(*[F.length(F.regexp_replace(F.rtrim(token, F.lit("=")), other, "")) for other in ("[^0-9]", "[^a-z]", "[^A-Z]", "[A-Za-z0-9]")])
    mixed = F.rlike(token, F.lit("[0-9]")) & F.rlike(token, F.lit("[A-Za-z]"))

    def tested(known: Column) -> Column:
        v, k = known["values"], known["size"]
        n = F.size(v).cast("double")
        counts = F.transform(
            F.sequence(F.lit(0), F.lit(CELLS - 1)),
            lambda cell: F.aggregate(v, F.lit(0.0), lambda s, x: s + F.when(F.floor(x * CELLS / k) == cell, 1.0).otherwise(0.0)),
        )
        chi = F.aggregate(counts, F.lit(0.0), lambda s, c: s + (c - n / CELLS) * (c - n / CELLS) / (n / CELLS))
        p_cells = _chi_squared_tail(chi, F.lit(float(CELLS - 1)))
        by_class = F.zip_with(
            known["seen"],
            known["classes"],
            lambda c, m: F.when(m > 0, (c - n * m / k) * (c - n * m / k) / (n * m / k)).otherwise(0.0),
        )
        used = F.aggregate(known["classes"], F.lit(-1.0), lambda s, m: s + F.when(m > 0, 1.0).otherwise(0.0))
        p_classes = _chi_squared_tail(F.aggregate(by_class, F.lit(0.0), lambda s, c: s + c), used)
        upper = F.aggregate(v, F.lit(0.0), lambda s, x: s + F.when(x * 2 >= k, 1.0).otherwise(0.0))
        pairs = F.zip_with(F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        runs = F.aggregate(pairs, F.lit(1.0), lambda s, p: s + F.when((p["a"] * 2 >= k) != (p["b"] * 2 >= k), 1.0).otherwise(0.0))
        expected = 1 + 2 * upper * (n - upper) / n
        spread = (expected - 1) * (expected - 2) / (n - 1)
        p_runs = F.when(spread > 0, 2 * _upper_tail(F.abs(runs - expected) / F.sqrt(spread))).otherwise(0.0)
        mean = F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / n
        squares = F.aggregate(v, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
        lagged = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["a"] - mean) * (p["b"] - mean))
        p_serial = F.when(squares > 0, 2 * _upper_tail(F.abs(lagged / squares + 1 / n) * F.sqrt(n))).otherwise(0.0)
        return F.struct(
            F.least(F.lit(1.0), 4 * F.least(p_cells, p_classes, p_runs, p_serial)).alias("p"), (n * F.log2(k.cast("double"))).alias("bits")
        )

    none = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("bits"))
    known = F.struct(values.alias("values"), size.alias("size"), classes.alias("classes"), seen.alias("seen"))
    return F.when(mixed & size.isNotNull(), F.transform(F.array(known), tested)[0]).otherwise(none)


def _stratum(length: Column) -> Column:
    """Tokens are controlled among those of like length, since long ones are dismissed more easily."""
    return F.floor(F.log2(length.cast("double"))).cast("int")


def scanned(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns with ``_base`` (spans of the patterns) and ``_tested`` (other candidates with p, bits and stratum)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, text.alias("_text"))
    base = [
        _spans(F.col("_text"), LONG_RUNS.get(name, pattern), group, least, kind)
        for kind, (name, pattern, group, least) in enumerate(PATTERNS)
    ]
    rows = rows.select(
        "*", F.array_sort(F.concat(*base)).alias("_base"), _spans(F.col("_text"), CANDIDATE, 0, 20, RANDOM).alias("_runs")
    )
    apart = F.filter(
        "_runs", lambda r: ~F.exists("_base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
    )

    def tested(run: Column) -> Column:
        length = run["end"] - run["start"]
        result = randomness(F.substr(F.col("_text"), run["start"] + 1, length))
        return F.struct(
            run["start"], run["kind"], run["end"], result["p"].alias("p"), result["bits"].alias("bits"), _stratum(length).alias("stratum")
        )

    strong = F.filter(F.transform(apart, tested), lambda t: t["bits"] >= MIN_BITS)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,p:double,bits:double,stratum:int>>")
    return rows.select("*", F.when(F.size("_runs") > 0, strong).otherwise(none).alias("_tested"))


def _step(p: Column) -> Column:
    return F.floor(-F.log10(F.greatest(p, F.lit(SMALLEST))) * STEPS)


def dismissed_below(tested: DataFrame) -> Column:
    """From p-values by stratum to a map: stratum -> p at and below which tokens are dismissed as not random.

    Benjamini and Hochberg's bound on steps of p: tokens are counted per stratum
    and step, so the numbers do not depend on the number of tokens, and a stratum
    (a power of two of length) gives one row to the driver.
    """
    steps = tested.groupBy("stratum", _step(F.col("p")).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    smaller = Window.partitionBy("stratum").orderBy(F.col("step").desc())
    upto, total = F.sum("n").over(smaller), F.sum("n").over(Window.partitionBy("stratum"))
    bound = F.pow(F.lit(10.0), -F.col("step") / STEPS)
    steps = steps.select("stratum", bound.alias("bound"), (upto * FALSE_DISCOVERIES / total).alias("allowed"))
    rows = steps.filter("bound <= allowed").groupBy("stratum").agg(F.max("bound").alias("bound")).collect()
    pairs = [F.lit(x) for r in rows for x in (r["stratum"], r["bound"])]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<int,double>")


def _all_spans(bounds: Column) -> Column:
    random = F.filter("_tested", lambda t: t["p"] > F.coalesce(F.try_element_at(bounds, t["stratum"]), F.lit(0.0)))
    return F.array_sort(F.concat("_base", F.transform(random, lambda t: F.struct(t["start"], t["kind"], t["end"]))))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``spans`` (start, kind, end) and ``base`` (those of the fixed patterns).

    Spans are ordered by start, then kind, in code points with an exclusive end; kinds
    are numbers into ``KINDS``. Null and empty texts have none. Repeated rows and null
    ids are scanned each; other columns are left out.
    """
    found = stored(scanned(docs, "doc_id").select("doc_id", "_base", "_tested"))
    bounds = dismissed_below(found.select(F.explode("_tested").alias("t")).select("t.stratum", "t.p"))
    return found.select("doc_id", _all_spans(bounds).alias("spans"), F.col("_base").alias("base"))


def secret_digests(docs: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base spans, and the list of all spans as text."""
    found = find_secrets(docs)

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [number(kind).alias(f"n_{name}") for kind, (name, *_) in enumerate(PATTERNS)]
    base = F.sha2(_listed(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of a secret replaced by a mark; texts without secrets and all other columns stay.

    Null texts stay null, empty ones empty; repeated rows are masked alike, and none is dropped.
    """
    names = docs.columns
    # All columns in one, so that no name of theirs meets one of the steps.
    rows = docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"), "text")
    bounds = dismissed_below(scanned(docs).select(F.explode("_tested").alias("t")).select("t.stratum", "t.p"))
    rows = scanned(rows, "_row").withColumn("_spans", _all_spans(bounds))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        kept = F.substr(F.col("_text"), state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], kept, F.lit(MARK))).otherwise(state["out"]).alias("out"),
        )

    walked = F.aggregate("_spans", start, step)
    rest = F.substr(F.col("_text"), walked["at"] + 1, F.length("_text"))
    text = F.when(F.size("_spans") > 0, F.concat(walked["out"], rest)).otherwise(F.col("_row")["text"])
    return rows.select(*[(text if c == "text" else F.col("_row")[c]).alias(c) for c in names])
