"""Secrets in texts: three fixed patterns, and a battery of randomness tests for the rest.

Candidates of the battery are runs of 20 or more letters, digits and + / _ - that hold a
letter. A run with characters of both + / and _ - is read in both ways, split at the one pair
and at the other, and the parts of 20 or more are tested; a find inside a longer one is left
out. Each gets an encoding by the characters it uses (hexadecimal, base 32,
base 36 in one case, base 64). Three tests ask whether it looks drawn evenly from that
alphabet: chi-squared of the character counts, the number of runs of low and high halves of
the alphabet, and the correlation of neighbours. Fisher's method combines the three p-values;
a candidate that they reject is not random.

Short texts pass such tests by chance, so a second p-value says how likely a name or word
would look as random: one over the likelihood ratio of the even alphabet against letter
frequencies of text, which bounds that chance (Markov's inequality) and falls with the
length. These p-values, weighted by length, go through Benjamini and Hochberg's procedure
over the candidates of the document, which keeps the share of false finds below `fdr`.

Places come from splitting: the lengths of the parts between the matches, added up, so all
is built-in functions on one row. Nothing is shuffled.

Defined results: a NULL text is the empty text and has no spans; NULL ids stay; repeated
rows are scanned one by one; an empty table gives no rows; other columns are ignored. Places
are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import bound, text_of

# The patterns of the base kinds. A run shorter than its kind's least length
# is no match, and no later match can begin inside such a run, so the length stands in the
# pattern where there is one run only.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LENGTH = 12
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: Both readings of a run that mixes + / with _ -.
READINGS = (r"[A-Za-z0-9_-]{20,}", r"[A-Za-z0-9+/]{20,}")
LOWER = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"
#: Alphabets by encoding, each with the pattern of what belongs to it; the first that fits.
ENCODINGS = (
    ("hex", DIGITS + "abcdef", r"^[0-9a-f]+$"),
    ("HEX", DIGITS + "ABCDEF", r"^[0-9A-F]+$"),
    ("base32", LOWER.upper() + "234567", r"^[A-Z2-7]+$"),
    ("base36", DIGITS + LOWER, r"^[0-9a-z]+$"),
    ("BASE36", DIGITS + LOWER.upper(), r"^[0-9A-Z]+$"),
    ("base64", LOWER.upper() + LOWER + DIGITS + "+/", r"^[A-Za-z0-9+/]+$"),
    ("base64url", LOWER.upper() + LOWER + DIGITS + "-_", r"^[A-Za-z0-9_-]+$"),
)
# Percent of each letter in English text, a to z.
LETTER_PERCENT = (
    8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4,
    6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074,
)


def _text_share(character: str) -> float:
    """Share of a character in names and words: lower case letters mostly, few digits."""
    if character in LOWER:
        return 0.78 * LETTER_PERCENT[LOWER.index(character)] / 100
    if character.isalpha():
        return 0.12 * LETTER_PERCENT[LOWER.index(character.lower())] / 100
    return 0.07 / 10 if character.isdigit() else 0.03 / 4

#: Matches whose places are listed at a time.
CHUNK = 256


def _spans(text: Column, pattern: str, keep=None) -> Column:
    """Places (start, end) and strings of all matches that `keep` accepts."""
    kept = keep or (lambda match: F.lit(True))

    def placed(parts: Column, matches: Column) -> Column:
        """Places within chunks of matches, and then those of the chunks: a list that grew by
        one match after the other would be copied as often."""
        ends = F.zip_with(parts, matches, lambda p, m: F.struct(F.char_length(p).alias("p"), m.alias("m")))
        starts = F.sequence(F.lit(1), F.size(parts), F.lit(CHUNK))
        return bound(
            bound(ends, lambda e: F.transform(starts, lambda i: chunk(F.slice(e, i, CHUNK)))),
            lambda chunks: F.flatten(F.zip_with(chunks, lengths_before(chunks), moved)),
        )

    def chunk(ends: Column) -> Column:
        none = F.array().cast("array<struct<start:int,end:int,match:string>>")
        return F.aggregate(
            ends,
            F.struct(F.lit(0).alias("at"), none.alias("found")),
            lambda a, x: bound(
                F.struct(
                    (a["at"] + x["p"]).alias("s"),
                    (a["at"] + x["p"] + F.coalesce(F.char_length(x["m"]), F.lit(0))).alias("e"),
                ),
                lambda y: F.struct(
                    y["e"].alias("at"),
                    F.when(
                        x["m"].isNotNull() & kept(x["m"]),
                        F.concat(
                            a["found"],
                            F.array(F.struct(y["s"].alias("start"), y["e"].alias("end"), x["m"].alias("match"))),
                        ),
                    ).otherwise(a["found"]).alias("found"),
                ),
            ),
        )

    def lengths_before(chunks: Column) -> Column:
        return F.aggregate(
            chunks,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before")),
            lambda a, x: F.struct(
                (a["at"] + x["at"]).alias("at"), F.concat(a["before"], F.array(a["at"])).alias("before")
            ),
            lambda a: a["before"],
        )

    def moved(one: Column, before: Column) -> Column:
        return F.transform(
            one["found"],
            lambda f: F.struct(
                (f["start"] + before).alias("start"), (f["end"] + before).alias("end"), f["match"].alias("match")
            ),
        )

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return bound(
        matches,
        lambda m: F.when(F.size(m) == 0, F.array().cast("array<struct<start:int,end:int,match:string>>")).otherwise(
            placed(F.split(text, pattern, -1), m)
        ),
    )


def _readings(candidate: Column) -> Column:
    """A candidate, or the parts of one that no encoding has."""

    def parts(pattern: str) -> Column:
        return F.transform(
            _spans(candidate["match"], pattern),
            lambda x: F.struct(
                (candidate["start"] + x["start"]).alias("start"), (candidate["start"] + x["end"]).alias("end"),
                x["match"].alias("match"),
            ),
        )

    mixed = candidate["match"].rlike("[+/]") & candidate["match"].rlike("[_-]")
    return F.when(mixed, F.array_distinct(F.concat(*[parts(pattern) for pattern in READINGS]))).otherwise(F.array(candidate))


def _apart(found: Column) -> Column:
    """Finds without those inside a longer one, from the other reading of the same run."""
    return F.filter(
        found,
        lambda x: ~F.exists(
            found, lambda y: (y["start"] <= x["start"]) & (x["end"] <= y["end"]) & (y["n"] > x["n"])
        ),
    )


def _upper_tail(z: Column) -> Column:
    """Chance that a normal value exceeds z; the logistic form is right to 0.0002."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), 0.07056 * z * z * z + 1.5976 * z)))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z)))


def _battery(token: Column, alphabet: str) -> Column:
    """p-values of the three tests combined, and the log likelihood ratio against text."""
    k = len(alphabet)
    n = F.char_length(token).cast("double")
    counts = F.transform(
        F.array(*[F.lit(c) for c in alphabet]),
        lambda c: (F.char_length(token) - F.char_length(F.replace(token, c, F.lit("")))).cast("double"),
    )
    halves = F.translate(token, alphabet, "0" * (k // 2) + "1" * (k - k // 2))
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double"))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)

    def chi(c: Column) -> Column:
        square = k / n * total(F.transform(c, lambda x: x * x)) - n
        free = float(k - 1)
        cube = F.pow(F.greatest(square, F.lit(1e-9)) / free, F.lit(1 / 3))
        return _upper_tail((cube - (1 - 2 / (9 * free))) / (2 / (9 * free)) ** 0.5)

    def runs(h: Column) -> Column:
        ones = F.char_length(F.replace(h, F.lit("0"), F.lit(""))).cast("double")
        zeros = n - ones
        changes = (
            2 * F.char_length(h)
            - F.char_length(F.replace(h, F.lit("01"), F.lit("")))
            - F.char_length(F.replace(h, F.lit("10"), F.lit("")))
        ) / 2
        both = 2 * ones * zeros
        spread = both * (both - n) / (n * n * (n - 1))
        return F.when(spread <= 0, F.lit(1e-6)).otherwise(_two_sided((changes + 1 - both / n - 1) / F.sqrt(spread)))

    def serial(x: Column) -> Column:
        mean = (k + 1) / 2
        spread = (k * k - 1) / 12
        pairs = F.zip_with(
            F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), lambda a, b: (a - mean) * (b - mean)
        )
        return _two_sided(total(pairs) / (spread * F.sqrt(n - 1)))

    weights = F.array(*[F.lit(1 / k / _text_share(c)) for c in alphabet])
    ratio = bound(counts, lambda c: F.struct(
        chi(c).alias("chi"), total(F.zip_with(c, weights, lambda x, w: x * F.ln(w))).alias("llr")
    ))
    return bound(
        F.struct(ratio.alias("c"), bound(halves, runs).alias("runs"), bound(places, serial).alias("serial")),
        lambda t: F.struct(
            bound(
                -F.ln(F.greatest(F.lit(1e-12), t["c"]["chi"]))
                - F.ln(F.greatest(F.lit(1e-12), t["runs"]))
                - F.ln(F.greatest(F.lit(1e-12), t["serial"])),
                lambda x: F.exp(-x) * (1 + x + x * x / 2),
            ).alias("p_random"),
            F.exp(-F.greatest(F.lit(0.0), F.least(F.lit(700.0), t["c"]["llr"]))).alias("p_text"),
        ),
    )


def _tested(candidate: Column) -> Column:
    token = candidate["match"]
    verdict, encoding = F.lit(None), F.lit(None).cast("string")
    for name, alphabet, pattern in reversed(ENCODINGS):
        verdict = F.when(token.rlike(pattern), _battery(token, alphabet)).otherwise(verdict)
        encoding = F.when(token.rlike(pattern), F.lit(name)).otherwise(encoding)
    return F.struct(
        candidate["start"].alias("start"), candidate["end"].alias("end"), encoding.alias("encoding"), verdict.alias("p"),
        (candidate["end"] - candidate["start"]).cast("double").alias("n"),
    )


def _discovered(tested: Column, fdr: float, alpha: float) -> Column:
    """Candidates that pass both the battery and the length-weighted procedure."""
    m = F.size(tested)
    mean = F.aggregate(tested, F.lit(0.0), lambda s, x: s + x["n"]) / m
    scaled = F.transform(
        tested, lambda x: F.coalesce(x["p"]["p_text"], F.lit(1.0)) * mean / x["n"]
    )

    def cut(ordered: Column) -> Column:
        passing = F.transform(ordered, lambda p, i: F.when(p <= fdr * (i + 1) / m, p))
        return F.array_max(passing)

    return bound(
        scaled,
        lambda s: bound(
            cut(F.sort_array(s)),
            lambda limit: F.filter(
                tested, lambda x, i: F.coalesce((F.get(s, i) <= limit) & (x["p"]["p_random"] >= alpha), F.lit(False))
            ),
        ),
    )


def find_secrets(docs: DataFrame, fdr: float = 0.001, alpha: float = 0.001) -> DataFrame:
    """(doc_id, base, random): spans of the fixed kinds, and those the battery adds.

    `base` holds (start, end, kind), `random` also the encoding and the p-values; a candidate
    inside a base span is left out, as it is found already.
    """
    text = F.col("text")

    def of(kind: int, spans: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(x["start"], F.lit(kind).alias("kind"), x["end"]))

    def long_enough(match: Column) -> Column:
        return F.char_length(F.regexp_extract(match, ASSIGN, 2)) >= ASSIGN_LENGTH

    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    base = F.sort_array(
        F.concat(
            of(0, _spans(text, ASSIGN, long_enough)),
            of(1, F.when(text.contains("AKIA"), _spans(text, ACCESS)).otherwise(none)),
            of(2, _spans(text, HEX)),
        )
    )
    runs = F.flatten(F.transform(_spans(text, CANDIDATE), _readings))
    candidates = F.filter(runs, lambda x: x["match"].rlike("[A-Za-z]"))
    empty = F.array().cast("array<struct<start:int,end:int,encoding:string,p:struct<p_random:double,p_text:double>,n:double>>")
    found = docs.select("doc_id", text_of().alias("text")).select(
        "doc_id",
        bound(
            F.struct(base.alias("base"), candidates.alias("candidates")),
            lambda f: F.struct(
                f["base"].alias("base"),
                F.when(F.size(f["candidates"]) == 0, empty)
                .otherwise(
                    F.filter(
                        bound(bound(F.transform(f["candidates"], _tested), lambda t: _discovered(t, fdr, alpha)), _apart),
                        lambda x: ~F.exists(f["base"], lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"])),
                    )
                )
                .alias("random"),
            ),
        ).alias("found"),
    )
    return found.select("doc_id", "found.base", "found.random")


def span_text(spans: Column) -> Column:
    """kind:start:end of (start, kind, end) in order of start, then kind."""
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )
