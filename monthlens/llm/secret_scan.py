r"""Secret scan with Spark expressions only: base patterns and a randomness test battery.

Base spans are the matches of three patterns. The method adds spans of kind ``random``: of the runs
of ``[A-Za-z0-9+/_=-]`` outside base spans, those of ``least`` characters or more that are too
random to be ordinary. A run's encoding is inferred (decimal, hex, base32, alphanumeric, base64),
and three tests ask whether its symbols look drawn at random from that alphabet: chi-squared
uniformity, runs of equal character classes, and lag-one serial correlation. Three times the least
of the p-values is the token's score; it is spread evenly up to 1 for random tokens and close to 0
for ordinary ones, the closer the longer they are.

What is to be controlled are false discoveries of secrets, so the null hypothesis is an ordinary
token. Its scores are not known by formula. They are measured on tokens made of words, joined as in
identifiers and paths: some from each document's own words, some from a list of common words. In
each class of lengths, a token's p-value is the share of these with a score as high, and
Benjamini-Hochberg reports tokens so that about ``fdr`` of the reported ones at most are ordinary.
Short tokens, where words and chance look alike, are reported only where random ones abound.

Defined cases: a null text is empty; empty texts and texts without a match have no spans (the
digest of the empty string); spans are in code points, end exclusive; repeated rows each get
their result, and a token that comes several times counts once; rows of one id with different texts
are told apart; an empty table gives no rows; the columns are addressed by name, others are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from monthlens.llm.shared import free_name, row_key, stored, text_or_empty, total

# Fixed patterns of the base rules. "{24,}" and "{16,}" find what "+" and a later test of the
# length find, as runs are taken whole.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """The matches of ``pattern`` as (start, kind, end), by start.

    The pieces between the matches and the matches themselves give all positions. The start
    runs along in the accumulator.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tails = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if keep else hits
    both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), tails.alias("tail"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(F.coalesce(x["hit"], F.lit("")))
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        good = x["hit"].isNotNull() & (F.length(x["tail"]) >= 6 if keep else F.lit(True))
        return F.struct(
            end.alias("at"),
            F.when(good, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    found = F.aggregate(both, start, step, lambda acc: acc["spans"])
    return F.when(F.size(hits) > 0, found).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    return F.concat(
        _spans(text, ASSIGN, 0, keep=True), _spans(text, ACCESS, 1), _spans(text, HEX, 2)
    )


def _normal_tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution: a rational approximation, 1.5e-7 at most off."""
    x = F.abs(z) / F.lit(math.sqrt(2))
    t = 1 / (1 + F.lit(0.3275911) * x)
    # coefficients of Abramowitz and Stegun 7.1.26
    terms = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    poly = total([F.lit(c) * F.pow(t, F.lit(float(i + 1))) for i, c in enumerate(terms)])
    return F.greatest(poly * F.exp(-x * x), F.lit(1e-300))


ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "alphanumeric": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}


def token_pattern(least: int) -> str:
    """Runs of ``least`` characters or more."""
    return rf"[A-Za-z0-9+/_=-]{{{least},}}"


def inferred(token: Column) -> Column:
    """The encoding of a token without padding, its symbols, and their alphabet."""
    lower = F.lower(token)
    encoding = (
        F.when(token.rlike("^[0-9]+$"), "decimal")
        .when(token.rlike(r"^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(token.rlike("^[A-Z2-7]+$"), "base32")
        .when(token.rlike("^[A-Za-z0-9]+$"), "alphanumeric")
        .otherwise("base64")
    )
    symbols = F.when(encoding == "hex", lower).otherwise(F.translate(token, "-_", "+/"))
    alphabet = F.lit("")
    for name, letters in ALPHABETS.items():
        alphabet = F.when(encoding == name, F.lit(letters)).otherwise(alphabet)
    return F.struct(encoding.alias("encoding"), symbols.alias("symbols"), alphabet.alias("alphabet"))


#: The classes of characters whose runs are counted.
_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "+/")


def _kind_of(symbol: Column) -> Column:
    kind = F.lit(-1)
    for i, letters in enumerate(_CLASSES):
        kind = F.when(F.instr(F.lit(letters), symbol) > 0, i).otherwise(kind)
    return kind


def _same_kind(encoding: Column) -> Column:
    """How often two and three symbols in a row of a random token are of one class."""
    values = F.lit(None).cast("struct<pairs:double,triples:double>")
    for name, alphabet in ALPHABETS.items():
        shares = [sum(c in letters for c in alphabet) / len(alphabet) for letters in _CLASSES]
        of_encoding = F.struct(
            F.lit(sum(q**2 for q in shares)).alias("pairs"),
            F.lit(sum(q**3 for q in shares)).alias("triples"),
        )
        values = F.when(encoding == name, of_encoding).otherwise(values)
    return values


def battery(tokens: DataFrame) -> DataFrame:
    """Adds ``p`` to rows with ``token``: three times the least p-value of the tests."""
    with_alphabet = tokens.withColumn(
        "_e", inferred(F.rtrim(F.translate("token", "=", " ")))
    ).withColumn(
        "_v",
        F.transform(
            F.split(F.col("_e.symbols"), ""),
            lambda c: F.instr(F.col("_e.alphabet"), c).cast("double"),
        ),
    )
    n, k = F.size("_v").cast("double"), F.length("_e.alphabet").cast("double")
    counts = F.transform(
        F.array_distinct("_v"),
        lambda v: F.pow(F.size(F.filter("_v", lambda x: x == v)).cast("double"), F.lit(2.0)),
    )
    add = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    measured = with_alphabet.withColumns(
        {
            "_n": n,
            "_k": k,
            "_squares": add(counts),
            "_mean": add(F.col("_v")) / n,
            "_kind": F.transform(F.split(F.col("_e.symbols"), ""), _kind_of),
            "_same": _same_kind(F.col("_e.encoding")),
        }
    ).withColumns(
        {
            "_pairs": F.arrays_zip(
                F.slice("_v", 1, F.size("_v") - 1).alias("a"), F.slice("_v", 2, F.size("_v")).alias("b")
            ),
            "_changes": F.size(
                F.filter(
                    F.arrays_zip(
                        F.slice("_kind", 1, F.size("_v") - 1).alias("a"),
                        F.slice("_kind", 2, F.size("_v")).alias("b"),
                    ),
                    lambda x: x["a"] != x["b"],
                )
            ).cast("double"),
            "_var": add(F.transform("_v", lambda v: F.pow(v - F.col("_mean"), F.lit(2.0)))),
        }
    )
    n, k, df = F.col("_n"), F.col("_k"), F.col("_k") - 1
    # chi-squared by the cube-root normal form, upper side only: evenness speaks for randomness
    chi = k / n * F.col("_squares") - n
    chi_z = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(
        2 / (9 * df)
    )
    chi_p = F.when(chi_z > 0, _normal_tail(chi_z) / 2).otherwise(1 - _normal_tail(chi_z) / 2)
    # as many changes of class as neighbours drawn from the alphabet have, in mean and variance
    same, same2 = F.col("_same.pairs"), F.col("_same.triples")
    runs_var = (n - 1) * (same * (1 - same) + 2 * (same2 - same * same))
    runs_p = F.when(
        runs_var > 0, _normal_tail((F.col("_changes") - (n - 1) * (1 - same)) / F.sqrt(runs_var))
    ).otherwise(F.lit(1.0))
    covariance = add(
        F.transform("_pairs", lambda x: (x["a"] - F.col("_mean")) * (x["b"] - F.col("_mean")))
    )
    serial_p = F.when(
        F.col("_var") > 0, _normal_tail((covariance / F.col("_var") + 1 / n) * F.sqrt(n))
    ).otherwise(F.lit(0.0))
    p = F.least(F.lit(1.0), 3 * F.least(chi_p, runs_p, serial_p))
    return measured.withColumn("p", F.greatest(p, F.lit(1e-300))).select(*tokens.columns, "p")


BINS_PER_DECADE = 20


#: The last class of lengths has all tokens from 64 characters on.
_LAST_CLASS = 12


def _length_class(token: Column) -> Column:
    """Classes of lengths by half powers of two."""
    exact = F.floor(2 * F.log2(F.length(token).cast("double"))).cast("int")
    return F.least(exact, F.lit(_LAST_CLASS))


def scored(tokens: DataFrame) -> DataFrame:
    """Distinct tokens with their length class and the bin of their score; bin 0 is most random."""
    return battery(tokens.select("token").distinct()).select(
        "token",
        _length_class(F.col("token")).alias("length_class"),
        F.floor(-F.log10("p") * BINS_PER_DECADE).cast("int").alias("bin"),
    )


#: Words that names in programs, paths and texts are made of, for tokens of the null hypothesis.
COMMON = (
    "account action active address agent amount article author backup before between block board "
    "browser budget build button cache category center change channel chapter client cluster code "
    "column comment common company config content control count country current customer data date "
    "default delete detail device display document domain driver email engine error event example "
    "export factory field file filter folder format friday function gallery general global group "
    "handler header height history home image import index information input install internal item "
    "job journal key label language last layer length letter level library license limit list local "
    "location login machine manager market master member memory menu message method model module "
    "monday name network news node note number object office open option order output package page "
    "panel parent password path payment people person phone photo picture policy position price "
    "private process product profile program project public query range reader record region release "
    "report request resource response result review school screen script search section security "
    "select server service session setting shop simple size source space start state status storage "
    "store string style summary support system table target team template test text theme thread "
    "time title token topic total track transfer type update upload user value version video view "
    "weather website week widget width window winter word world writer year zone"
)
#: Tokens made of the common words.
REFERENCE = 20_000


def _styled(words: Column, seed: Column) -> Column:
    """Words joined as in an identifier, a path or a camel-case name, half of them with a number."""
    draw = lambda n, of: F.pmod(F.xxhash64(seed, F.lit(n)), F.lit(of))
    letters = F.transform(words, lambda w: F.regexp_replace(w, "[^A-Za-z]", ""))
    plain = F.filter(letters, lambda w: w != "")
    cased = F.transform(
        plain, lambda w, i: F.when(F.pmod(F.xxhash64(seed, i), F.lit(2)) == 0, F.initcap(w)).otherwise(w)
    )
    plain = F.when(draw(5, 2) == 0, cased).otherwise(plain)
    joined = F.array_join(plain, "")
    for style, mark in enumerate("_-/"):
        joined = F.when(draw(1, 5) == style, F.array_join(plain, mark)).otherwise(joined)
    camel = F.array_join(F.transform(plain, F.initcap), "")
    joined = F.when(draw(1, 5) == 3, camel).otherwise(joined)
    number = F.concat(F.when(draw(6, 2) == 0, "_").otherwise(""), draw(2, 4000).cast("string"))
    return F.when(draw(7, 2) == 0, F.concat(joined, number)).otherwise(joined)


def _how_many(seed: Column) -> Column:
    return (2 + F.pmod(F.xxhash64(seed, F.lit(3)), F.lit(10))).cast("int")


def ordinary_tokens(spark: SparkSession, texts: DataFrame, least: int) -> DataFrame:
    """Tokens of the null hypothesis: one from each text (``text``), ``REFERENCE`` of common words."""
    seed = F.xxhash64("text")
    words = F.split("text", " ")
    begin = F.pmod(F.xxhash64("text", F.lit(4)), F.greatest(F.size(words), F.lit(1))) + 1
    own = texts.select(_styled(F.slice(words, begin.cast("int"), _how_many(seed)), seed).alias("token"))
    common = F.split(F.lit(COMMON), " ")
    drawn = F.transform(
        F.sequence(F.lit(1), _how_many(F.col("id"))),
        lambda i: F.get(common, F.pmod(F.xxhash64("id", i), F.lit(len(COMMON.split()))).cast("int")),
    )
    made = spark.range(REFERENCE).select(_styled(drawn, F.col("id")).alias("token"))
    return own.unionByName(made).where(F.length("token") >= least)


def discoveries(tested: DataFrame, ordinary: DataFrame, fdr: float) -> DataFrame:
    """Per length class, the last bin that is reported.

    ``tested`` and ``ordinary`` are scored tokens. Both are counted by bin, at most 300 * 20 of
    them per class. From the most random bin on, the share of ordinary tokens so far is the p-value
    of a bin; the widest set of bins is reported whose p-value is at most ``fdr`` times its
    share of the tested tokens.
    """
    counts = [
        df.groupBy("length_class", "bin").agg(F.count("*").alias(name))
        for df, name in ((tested, "n"), (ordinary, "null"))
    ]
    both = counts[0].unionByName(counts[1], allowMissingColumns=True)
    both = both.groupBy("length_class", "bin").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("null"), F.lit(0)).alias("null")
    )
    whole = Window.partitionBy("length_class")
    so_far = whole.orderBy("bin")
    ranked = both.select(
        "length_class",
        "bin",
        F.try_divide(F.sum("n").over(so_far), F.sum("n").over(whole)).alias("share"),
        ((1 + F.sum("null").over(so_far)) / (1 + F.sum("null").over(whole))).alias("p"),
    )
    return (
        ranked.where(F.col("p") <= fdr * F.col("share"))
        .groupBy("length_class")
        .agg(F.max("bin").alias("last_reported"))
    )


def _masked(text: Column, spans: Column, mark=None) -> Column:
    """``text`` with each span, and spans that overlap as one, replaced by ``mark`` or by blanks."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = text.substr(acc["at"] + 1, s["start"] - acc["at"])
        if mark is None:
            blank = F.repeat(F.lit(" "), s["end"] - F.greatest(s["start"], acc["at"]))
            out = F.concat(acc["out"], F.when(fresh, gap).otherwise(""), blank)
        else:
            out = F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text)))
    return F.aggregate(F.array_sort(spans), start, step, rest)


def scan(docs: DataFrame, least: int = 20, fdr: float = 0.05) -> DataFrame:
    """Spans of every document: ``doc_id``, ``base`` and ``added``, arrays of (start, kind, end),
    and ``row_key``, which stands for a row's id and text.

    ``kind`` counts along ``KINDS``. ``least``: characters of a token that is tested. A token that
    base spans touch is cut at them, and what is left of it judged by itself.
    """
    text = docs.select("doc_id", row_key().alias("row_key"), text_or_empty().alias("text"))
    based = text.withColumn("base", base_spans(F.col("text")))
    outside = F.when(F.size("base") > 0, _masked(F.col("text"), F.col("base"))).otherwise(F.col("text"))
    pattern = token_pattern(least)
    found = based.withColumn("text", outside).select(
        "doc_id",
        "row_key",
        "base",
        F.arrays_zip(
            _spans(F.col("text"), pattern, 3).alias("spans"),
            F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("tokens"),
        ).alias("candidates"),
    )
    found = stored(found)
    tokens = found.select(F.explode("candidates.tokens").alias("token"))
    tested = stored(scored(tokens))
    ordinary = scored(ordinary_tokens(docs.sparkSession, text, least))
    return _with_added(found, tested, discoveries(tested, ordinary, fdr))


def _with_added(found: DataFrame, tested: DataFrame, limits: DataFrame) -> DataFrame:
    random_tokens = (
        tested.join(limits, "length_class").where("bin <= last_reported").select("token")
    )
    # a frequent token is one row here; adaptive execution splits its occurrences
    spans = (
        found.where(F.size("candidates") > 0)
        .select("row_key", F.explode("candidates").alias("c"))
        .select("row_key", F.col("c.spans").alias("span"), F.col("c.tokens").alias("token"))
        .join(random_tokens, "token", "left_semi")
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_set("span")).alias("added"))
    )
    return found.join(spans, "row_key", "left").select(
        "doc_id",
        "row_key",
        "base",
        F.coalesce("added", F.array().cast(SPAN)).alias("added"),
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]),
        ),
        ",",
    )


def digests(scanned: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.concat("base", "added")).alias("spans"),
    )


def redact(docs: DataFrame, scanned: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; columns and other texts as they are.

    Overlapping spans are replaced together.
    """
    key, spans = free_name(docs, "_row_key"), free_name(docs, "_spans")
    found = scanned.select(
        F.col("row_key").alias(key), F.concat("base", "added").alias(spans)
    ).where(F.size(spans) > 0)
    joined = docs.withColumn(key, row_key()).join(found.dropDuplicates([key]), key, "left")
    clean = _masked(F.col("text"), F.col(spans), mark)
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(clean)
    return joined.withColumn("text", text).select(*docs.columns)
