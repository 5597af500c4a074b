"""Personal data replaced by surrogates of the same kind.

Found are e-mail addresses, IPv4 addresses, card and social security numbers, telephone
numbers (compact ones too), names of up to four words behind a form of address, and the bare
words of such a name in the rest of its document. Each value, in a canonical form (lower case, or
digits only), gives a surrogate by a keyed hash, so a value has one surrogate everywhere in
the corpus, however it is written, and the writing (separators, case, country code, form of
address) stays as it was. Surrogates keep the kind: addresses from the reserved range
240.0.0.0/4, mail domains below .example, card numbers with the same issuer digit and as
valid by Luhn's rule as the original, social security numbers from the 900s, names in the
script of the original with an ending for the gender that the form of address tells. A
name's words are replaced one by one, so "Mr. A B" and "Mr. B" stay the same person.

Collision check: the distinct values of the corpus are one table. Values whose surrogates
are equal, or equal to a value that occurs, take their next surrogate until none collide;
this keeps different values different. From the third attempt on an address may grow, and
from the fifth on leave the reserved range, so that there are surrogates for any number. Only the few values that needed it are kept, with
their number of attempts, and joined to the documents that hold them.

Texts are not shuffled unless that table outgrows what Spark broadcasts by its size.

Defined results: a NULL text stays NULL; an empty text stays empty; repeated rows get equal
texts; a NULL doc_id is joined as a value; an empty table gives no rows. Columns other than
those of `documents` are ignored. `n_chars` is that of the new text.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import bound, discard, stored, text_of

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP = rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{16}|[2-6][0-9]{12,18}|[2-6][0-9]{3}(?:[ -][0-9]{4}){3}|3[0-9]{3}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"
# A telephone number behind a plus has 8 to 15 digits, compact or in groups of any size. Within a
# country there are groups of two to eight digits, or ten digits in one.
E164 = r"(?<![0-9A-Za-z+])\+(?:[0-9]{8,15}|[0-9](?:[ .()-]{0,2}[0-9]){7,14})(?![0-9])"
NATIONAL = (
    r"(?<![0-9A-Za-z.+-])(?:\([0-9]{2,5}\)[ .-]?[0-9]{5,8}|0[0-9](?:[ .-][0-9]{2}){4}|0[1-9][0-9]{1,3}[ ./-][0-9]{5,8}"
    r"|[2-9][0-9]{2}[ .-][0-9]{7}|0[1-9][0-9]{8,10}|[2-9][0-9]{2}[2-9][0-9]{6})(?![0-9A-Za-z]|[.-][0-9])"
)
# Forms of address by the gender they tell.
MALE = ("Mr", "Herr", "Señor", "Monsieur", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "г-жа")
NEUTRAL = ("Dr", "Prof")
_FORM = rf"(?<!\p{{L}})(?:{'|'.join((*FEMALE, *MALE, *NEUTRAL))})\.?"
_WORD = r"\p{Lu}(?:\p{Ll}+|['’]\p{Lu}\p{Ll}+)(?:['’-]?\p{Lu}\p{Ll}+)*"
_INITIAL = r"\p{Lu}(?:\.|(?=\x20))"
NAME = rf"{_FORM} +(?:(?:{_WORD}|{_INITIAL}) +){{0,3}}{_WORD}"
PATTERN = "|".join((EMAIL, IP, CARD, SSN, PHONE, E164, NATIONAL, NAME))

#: Syllables of invented names by script, and endings by gender.
SYLLABLES = {
    "latin": ("ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu", "na", "pe", "ri", "so", "tu", "va"),
    "cyrillic": ("ба", "ве", "ги", "до", "жу", "за", "ке", "ли", "мо", "ну", "па", "ре", "си", "то", "фу", "ха"),
}
ENDINGS = {"latin": {"m": "ro", "f": "lia", "x": "en", "s": "mer"}, "cyrillic": {"m": "рон", "f": "лия", "x": "ен", "s": "мер"}}

_ENTITY = "struct<kind:string,value:string>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _kind(match: Column) -> Column:
    whole = lambda pattern: match.rlike(f"^(?:{pattern})$")
    return (
        F.when(match.contains("@"), "email")
        .when(whole(_OCTET + rf"(?:\.{_OCTET}){{3}}"), "ip")
        .when(whole(SSN), "ssn")
        .when(whole(CARD), "card")
        .when(match.rlike(r"^\p{L}"), "name")
        .otherwise("phone")
    )


def _name_words(match: Column) -> Column:
    """(kind, value) of each word of a name; the last word is the surname."""
    form = F.regexp_extract(match, f"^{_FORM}", 0)
    words = F.split(F.ltrim(F.substring(match, F.char_length(form) + 1, F.char_length(match))), " +")
    bare = F.rtrim(form, F.lit("."))
    gender = F.when(bare.isin(*MALE), "m").when(bare.isin(*FEMALE), "f").otherwise("x")
    return F.transform(
        words,
        lambda w, i: F.struct(
            F.concat(
                F.lit("name_"),
                F.when(i == F.size(words) - 1, F.lit("s")).otherwise(gender),
                F.when(w.rlike(r"^\p{IsCyrillic}"), F.lit("_cyrillic")).otherwise(F.lit("_latin")),
            ).alias("kind"),
            w.alias("value"),
        ),
    )


def _entities(match: Column) -> Column:
    """The canonical values of a match: one, or a name's words."""

    def single(kind: Column) -> Column:
        value = (
            F.when(kind == "email", F.lower(match))
            .when(kind == "ip", match)
            .when(kind == "phone", F.right(_digits(match), F.lit(10)))
            .otherwise(_digits(match))
        )
        return F.array(F.struct(kind.alias("kind"), value.alias("value")))

    return bound(_kind(match), lambda k: F.when(k == "name", _name_words(match)).otherwise(single(k)))


def _byte(seed: Column, i: Column | int) -> Column:
    """The i-th byte of a hexadecimal hash, from the start again after the 32nd."""
    at = (F.lit(i) if isinstance(i, int) else i) % 32 * 2 + 1
    return F.conv(F.substring(seed, at, F.lit(2)), 16, 10).cast("int")


def _scrambled(text: Column, seed: Column) -> Column:
    """Letters for letters, digits for digits, the rest as it is."""
    letters = F.lit("abcdefghijklmnopqrstuvwxyz")
    return F.array_join(
        F.transform(
            F.split(text, ""),
            lambda c, i: F.when(c.rlike("[0-9]"), (_byte(seed, i) % 10).cast("string"))
            .when(c.rlike(r"\p{L}"), F.substring(letters, _byte(seed, i) % 26 + 1, F.lit(1)))
            .otherwise(c),
        ),
        "",
    )


def _syllable(seed: Column, syllables: tuple[str, ...], i: Column) -> Column:
    return F.get(F.array(*[F.lit(s) for s in syllables]), _byte(seed, i) % len(syllables))


def _luhn(digits: Column) -> Column:
    """Luhn's sum of all digits, modulo 10; 0 is valid."""
    n = F.char_length(digits)
    values = F.transform(
        F.split(digits, ""),
        lambda c, i: F.when((n - i) % 2 == 0, F.element_at(F.array(*[F.lit(2 * d - 9 * (d > 4)) for d in range(10)]), c.cast("int") + 1))
        .otherwise(c.cast("int")),
    )
    return F.aggregate(values, F.lit(0), lambda s, v: s + v) % 10


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The canonical surrogate of a canonical value; each attempt gives another."""

    def made(seed: Column) -> Column:
        n = F.char_length(value)
        some = F.substring(F.translate(F.repeat(seed, 2), "abcdef", "012345"), F.lit(1), n)
        local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
        labels = F.regexp_replace(domain, r"\.[^.]*$", "")
        domain_seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain).cast("binary"), 256)
        # Where a form has too few surrogates for all values, later attempts widen it.
        wider = F.when(attempt > 1, F.substring(F.translate(seed, "abcdef", "012345"), F.lit(40), attempt)).otherwise("")
        mail = F.concat(_scrambled(local, seed), wider, F.lit("@"), _scrambled(labels, domain_seed), F.lit(".example"))
        net = F.when(attempt < 4, _byte(seed, 0) % 15 + 240).otherwise(_byte(seed, 0) % 254 + 1)
        octets = [net.cast("string"), *[_byte(seed, i).cast("string") for i in (1, 2, 3)]]
        rest = F.substring(some, F.lit(2), n)
        card = F.concat(F.substring(value, 1, 1), F.substring(rest, F.lit(1), n - 2))
        check = bound(F.concat(card, F.lit("0")), lambda c: (10 - _luhn(c)) % 10)
        wrong = F.when(_luhn(value) == 0, 0).otherwise(1)
        name = F.lit(None).cast("string")
        for script, syllables in SYLLABLES.items():
            parts = F.transform(
                F.sequence(F.lit(0), 2 + F.floor(attempt / 3).cast("int")), partial(_syllable, seed, syllables)
            )
            for sex, ending in ENDINGS[script].items():
                name = F.when(kind == f"name_{sex}_{script}", F.initcap(F.concat(F.array_join(parts, ""), F.lit(ending)))).otherwise(name)
        return (
            F.when(kind == "email", mail)
            .when(kind == "ip", F.concat_ws(".", *octets))
            .when(kind == "ssn", F.concat(F.lit("9"), rest))
            .when(kind == "card", F.concat(card, ((check + wrong) % 10).cast("string")))
            .when(kind == "phone", F.concat((_byte(seed, 31) % 8 + 2).cast("string"), rest))
            .otherwise(name)
        )

    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string")).cast("binary"), 256)
    return bound(seed, made)


def _surrogate_of(entity: Column, attempts: Column, key: str) -> Column:
    tries = F.coalesce(F.try_element_at(attempts, F.concat_ws(":", entity["kind"], entity["value"])), F.lit(0))
    return surrogate(entity["kind"], entity["value"], tries, key)


def _filled(match: Column, digits: Column) -> Column:
    """The match with its last digits replaced by the given ones, in order."""
    kept = F.char_length(_digits(match)) - F.char_length(digits)
    at = lambda i: F.char_length(_digits(F.substring(match, F.lit(1), i + 1))) - kept
    return F.array_join(
        F.transform(
            F.split(match, ""),
            lambda c, i: F.when(c.rlike("[0-9]") & (at(i) > 0), F.substring(digits, at(i), F.lit(1))).otherwise(c),
        ),
        "",
    )


def _rendered(match: Column, attempts: Column, key: str) -> Column:
    """What stands in a text for a match."""

    def of(entity: Column) -> Column:
        return _surrogate_of(entity, attempts, key)

    def written(found: Column) -> Column:
        first = F.get(found, 0)
        kind = first["kind"]
        upper = (F.upper(match) == match) & (F.lower(match) != match)
        return (
            F.when(kind == "email", bound(of(first), lambda s: F.when(upper, F.upper(s)).otherwise(s)))
            .when(kind == "ip", of(first))
            .when(kind.isin("ssn", "card", "phone"), bound(of(first), lambda s: _filled(match, s)))
            .otherwise(F.concat(F.regexp_extract(match, f"^{_FORM} +", 0), F.array_join(F.transform(found, of), " ")))
        )

    return bound(_entities(match), written)


def _bare_replaced(part: Column, names: Column, attempts: Column, key: str) -> Column:
    """(text, n): a part between matches without the words that a name of the document has."""
    words = F.array_join(F.transform(names, lambda e: e["value"]), "|")
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), words, F.lit(r")(?!\p{L})"))

    def of(word: Column) -> Column:
        return bound(F.get(F.filter(names, lambda e: e["value"] == word), 0), lambda e: _surrogate_of(e, attempts, key))

    def replaced(hits: Column) -> Column:
        pieces = F.zip_with(
            F.split(part, pattern, -1), F.transform(hits, of), lambda p, new: F.concat(p, F.coalesce(new, F.lit("")))
        )
        return F.struct(
            F.when(F.size(hits) == 0, part).otherwise(F.array_join(pieces, "")).alias("text"), F.size(hits).alias("n")
        )

    return bound(F.regexp_extract_all(part, pattern, F.lit(0)), replaced)


def _matches(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def resolved(values: DataFrame, key: str, rounds: int = 50) -> DataFrame:
    """(kind, value, attempt) of distinct values such that no surrogates collide."""
    current = stored(values.withColumn("attempt", F.lit(0)), "pii_values")
    for _ in range(rounds):
        tried = current.withColumn("s", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key))
        tried = stored(tried, "pii_tried")
        shared = tried.groupBy("kind", "s").agg(F.min("value").alias("first"), F.count(F.lit(1)).alias("n"))
        later = tried.join(shared.where("n > 1"), ["kind", "s"]).where("value <> first").select("kind", "value")
        originals = tried.select(F.col("kind").alias("k"), F.col("value").alias("v"))
        real = tried.join(originals, (F.col("kind") == F.col("k")) & (F.col("s") == F.col("v")), "left_semi")
        bad = stored(later.unionByName(real.select("kind", "value")).distinct(), "pii_again")
        if bad.isEmpty():
            return current
        marked = current.join(bad.withColumn("again", F.lit(1)), ["kind", "value"], "left")
        following = stored(
            marked.select("kind", "value", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")), "pii_values"
        )
        discard(current, tried, bad)
        current = following
    raise RuntimeError(f"surrogates still collide after {rounds} rounds")


def replace_pii(docs: DataFrame, key: str = "surrogates-1") -> DataFrame:
    """Documents with surrogates in their texts, and `n_entities`, the number of places replaced."""
    given = docs.select(*[c for c in docs.columns if c in DOCUMENT])
    listed = F.flatten(F.transform(_matches(text_of()), _entities))
    exploded = given.select("doc_id", F.explode(listed).alias("e")).select("doc_id", "e.kind", "e.value")
    values = resolved(exploded.select("kind", "value").distinct(), key)
    again = stored(values.where("attempt > 0"), "pii_attempts")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    if again.isEmpty():
        with_attempts = given.withColumn("pii_attempts", empty)
    else:
        # A document's map holds at most its own values.
        name = F.concat_ws(":", "kind", "value")
        maps = stored(
            exploded.distinct()
            .join(again, ["kind", "value"])
            .groupBy("doc_id")
            .agg(F.map_from_entries(F.collect_set(F.struct(name, "attempt"))).alias("pii_attempts")),
            "pii_documents",
        )
        known = maps.select(F.col("doc_id").alias("pii_doc"), "pii_attempts")
        with_attempts = given.join(known, F.col("doc_id").eqNullSafe(F.col("pii_doc")), "left").withColumn(
            "pii_attempts", F.coalesce("pii_attempts", empty)
        )

    def rewritten(found: Column) -> Column:
        # An initial alone is too common a word to be looked for.
        named = F.filter(
            F.flatten(F.transform(found, _entities)), lambda e: e["kind"].startswith("name_") & e["value"].rlike(r"^\p{L}.*\p{L}$")
        )

        def cleaned(part: Column, names: Column) -> Column:
            whole = F.struct(part.alias("text"), F.lit(0).alias("n"))
            return F.when(F.size(names) == 0, whole).otherwise(_bare_replaced(part, names, F.col("pii_attempts"), key))

        parts = bound(
            F.array_distinct(named), lambda names: F.transform(F.split("text", PATTERN, -1), lambda p: cleaned(p, names))
        )
        new = F.transform(found, lambda m: _rendered(m, F.col("pii_attempts"), key))

        def joined(parts: Column) -> Column:
            texts = F.zip_with(parts, new, lambda part, new: F.concat(part["text"], F.coalesce(new, F.lit(""))))
            bare = F.aggregate(parts, F.lit(0), lambda n, part: n + part["n"])
            return F.struct(F.array_join(texts, "").alias("text"), (F.size(found) + bare).cast("long").alias("n"))

        same = F.struct(F.col("text").alias("text"), F.size(found).cast("long").alias("n"))
        return F.when(F.size(found) == 0, same).otherwise(bound(parts, joined))

    done = with_attempts.withColumn("pii", bound(_matches(F.col("text")), rewritten))
    out = {"text": F.col("pii.text"), "n_entities": F.coalesce(F.col("pii.n"), F.lit(0).cast("long"))}
    if "n_chars" in given.columns:
        out["n_chars"] = F.char_length("pii.text").cast("long")
    return done.withColumns(out).select(*given.columns, "n_entities")
