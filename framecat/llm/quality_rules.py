"""Quality rules with columns only: counts, repetition, and divergence from a language's histograms.

A document is compared with the reference of its language by the Jensen-Shannon distance of
two histograms: classes of characters, and the shares of eight common words and of all
others. A reference is the mean of the shares of all different texts of the language that
have the least lengths and pass the base rules, each counting once however many copies the
table has; the means are sums of whole millionths, so that reruns agree to the last bit. There are at most five references (four languages and one for
all others), whatever the input; they are five rows of numbers that go into the expressions.

No shuffle but those of the five sums and of fifteen numbers for each different text, no
Python in tasks. Texts of any length
stay in one row: windows of three words are sorted by a hash first and by their words
where hashes are equal, so that repetition is exact and costs n log n.

Defined results: a null text is an empty text, which fails the base rules; a row of a null
or unknown language is judged as one of the language whose words are nearest, and where none
is within the limit by its classes against all documents only; divergence is judged only where a text has the
least lengths, else it passes; without any reference (no long text in the table) all pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecat.functions.arrow_vectors import settled
from framecat.llm.common import raw_hash, whole, words_of
from framecat.session import materialise

# Frequent words of each language, most frequent first.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se"],
}
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_CHARS_FOR_CLASSES = 200
MIN_WORDS_FOR_COMMON = 100
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.23
UNIT = 1_000_000


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, though body uses it several times."""
    return F.transform(F.array(value), body)[0]


def _window_hash(a: Column, b: Column, c: Column) -> Column:
    return F.xxhash64(a, b, c)


def _covered(places: Column) -> Column:
    """Places within three of a start, for ascending different starts."""
    steps = F.zip_with(places, F.slice(places, 2, F.size(places)), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def _suspects(hashes: Column, hashed: Callable[..., Column]) -> Column:
    """Places of windows of three whose hash another one shares, from the hashes of the words.

    A window is one number, 32 bits of its hash above its place, since numbers sort far faster than structs.
    """
    of_three = lambda a, i: hashed(a, F.get(hashes, i + 1), F.get(hashes, i + 2))
    key = lambda a, i: F.shiftleft(of_three(a, i).bitwiseAND((1 << 32) - 1), 32).bitwiseOR(i.cast("long"))
    keys = F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - 2, F.lit(0))), key)
    high = lambda x: F.shiftright(x, 32)

    def shared(k: Column) -> Column:
        alike = lambda x, i: high(x).eqNullSafe(high(F.get(k, i + 1))) | high(x).eqNullSafe(high(F.get(k, i - 1)))
        return F.transform(F.filter(k, alike), lambda x: x.bitwiseAND((1 << 32) - 1).cast("int"))

    return _bind(F.sort_array(keys), shared)


def _repeat_words(words: Column, hashed: Callable[..., Column] = _window_hash) -> Column:
    """Words in windows of three that the text has twice or more.

    Windows whose hashes are equal are sorted by hash, words and place, so that words are compared only there.
    """

    def counted(found: Column, hashes: Column, places: Column) -> Column:
        def told(i: Column) -> Column:
            h = hashed(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2))
            three = [F.get(found, i + k).alias(name) for k, name in enumerate("abc")]
            return F.struct(h.alias("h"), *three, i.alias("i"))

        def twins(k: Column) -> Column:
            shorter = F.greatest(F.size(k) - 1, F.lit(0))
            alike = lambda x, y: (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
            return F.zip_with(
                F.slice(k, 1, shorter), F.slice(k, 2, shorter), lambda x, y: F.when(alike(x, y), F.array(x["i"], y["i"]))
            )

        pairs = F.filter(_bind(F.sort_array(F.transform(places, told)), twins), lambda pair: pair.isNotNull())
        return _bind(F.sort_array(F.array_distinct(F.flatten(pairs))), _covered)

    def of(found: Column) -> Column:
        each = lambda h, p: F.when(F.size(p) == 0, F.lit(0).cast("long")).otherwise(counted(found, h, p))
        return _bind(F.transform(found, lambda word: F.xxhash64(word)), lambda h: _bind(_suspects(h, hashed), lambda p: each(h, p)))

    return _bind(words, of)


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return _bind(lines, lambda found: (F.size(found) - F.size(F.array_distinct(found))).cast("long"))


def _pick(lang: Column, values: dict[str, Column], other: Column) -> Column:
    picked = None
    for name, value in values.items():
        picked = F.when(lang == name, value) if picked is None else picked.when(lang == name, value)
    return other if picked is None else picked.otherwise(other)


def _common_counts(padded: Column, lang: Column) -> Column:
    """How often each common word of the language stands alone in the text, whose words have two blanks around them."""
    out = []
    for place in range(8):
        needle = _pick(lang, {name: F.lit(f" {known[place]} ") for name, known in COMMON_WORDS.items()}, F.lit(None).cast("string"))
        gone = F.octet_length(padded) - F.octet_length(F.replace(padded, needle, F.lit("")))
        out.append((gone / F.octet_length(needle)).cast("long"))
    return F.array(*out)


def _word_shares(words: Column, lang: Column, total: Column) -> Column:
    """Shares of the common words: one histogram for a known language, else one for each language in their order."""
    told = lambda padded, name: _shares(_common_counts(padded, name), total)
    every = lambda padded: F.array(*[told(padded, F.lit(name)) for name in COMMON_WORDS])
    most = max(len(word.encode()) for known in COMMON_WORDS.values() for word in known)
    short = F.filter(words, lambda word: F.octet_length(word) <= most)  # longer ones need not be searched
    padded = F.concat(F.lit("  "), F.array_join(short, "  "), F.lit("  "))
    return _bind(padded, lambda s: F.when(lang == "", every(s)).otherwise(F.array(told(s, lang))))


def _shares(counts: Column, total: Column) -> Column:
    """Counts as whole millionths of the total; what is left of it is the last part. All zero without a total."""

    def parts(both: Column) -> Column:
        with_rest = F.concat(both["counts"], F.array(both["total"] - F.aggregate(both["counts"], F.lit(0).cast("long"), lambda s, x: s + x)))
        return F.transform(with_rest, lambda c: F.when(both["total"] > 0, F.floor(c * UNIT / both["total"])).otherwise(F.lit(0)).cast("long"))

    return _bind(F.struct(counts.alias("counts"), total.alias("total")), parts)


def _language(lang: Column) -> Column:
    return F.when(lang.isin(*COMMON_WORDS), lang).otherwise(F.lit(""))


def _measures(text: Column, lang: Column) -> Column:
    """Counts and histograms of one text as a struct. What is used twice is bound, since Spark computes
    an expression anew for each element of a lambda that mentions it."""

    def measured(r: Column) -> Column:
        body, words = r["text"], r["words"]
        gone = lambda pattern: F.char_length(body) - F.char_length(F.regexp_replace(body, pattern, ""))
        first = F.struct(
            F.char_length(body).cast("long").alias("n_chars"),
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            gone(f"[{SYMBOLS}]+").cast("long").alias("n_symbols"),
            (gone(r"\p{Lu}+")).cast("long").alias("upper"),
            (gone(r"[\p{Ll}\p{Lo}]+")).cast("long").alias("lower"),
            (gone(r"\p{Nd}+")).cast("long").alias("digit"),
        )

        def shaped(c: Column) -> Column:
            classes = F.array(c["upper"], c["lower"], c["digit"], c["n_chars"] - c["word_chars"], c["n_symbols"])
            told = [c[name].alias(name) for name in ("n_chars", "n_words", "word_chars", "n_symbols")]
            told.append(_shares(classes, c["n_chars"]).alias("classes"))
            told.append(_word_shares(words, r["lang"], c["n_words"]).alias("words_by"))
            told += [_dup_lines(body).alias("n_dup_lines"), _repeat_words(words).alias("n_repeat_words")]
            return F.struct(*told)

        return _bind(first, shaped)

    return _bind(F.struct(text.alias("text"), words_of(text).alias("words"), lang.alias("lang")), measured)


def measure(docs: DataFrame, text: str = "text", lang: str = "lang", carried: Column | None = None) -> DataFrame:
    """_row (what is carried along), lang, a hash of the text and the measures of every row; row by row.

    words_by has the histogram of the row's language, or those of all languages if it has none.
    """
    named = _language(F.col(lang))
    row = F.lit(None).cast("long") if carried is None else carried
    told = docs.select(row.alias("_row"), named.alias("_lang"), raw_hash(text).alias("_text"), settled(_measures(whole(text), named)).alias("_m"))
    return told.select("_row", "_lang", "_text", "_m.*", F.col("_m.words_by")[0].alias("words"))


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def references(measured: DataFrame) -> dict[str, tuple[list[int], list[int]]]:
    """Mean histograms by language, "" for all documents: at most five entries.

    Each different text of a language counts once, and those that fail the base rules do not
    count. Copies fold map-side to one row; plain columns keep that a hash aggregation.
    """
    long = (F.col("n_chars") >= MIN_CHARS_FOR_CLASSES) & (F.col("n_words") >= MIN_WORDS_FOR_COMMON)
    shares = [F.col("classes")[k].alias(f"c{k}") for k in range(6)] + [F.col("words")[k].alias(f"w{k}") for k in range(9)]
    names = [f"c{k}" for k in range(6)] + [f"w{k}" for k in range(9)]
    rows = measured.filter(long & ~_base_failed()).select("_lang", "_text", *shares)
    rows = rows.groupBy("_lang", "_text").agg(*[F.min(name).alias(name) for name in names])
    sums = [F.sum(name) for name in names]
    found = {}
    for row in rows.groupBy("_lang").agg(F.count(F.lit(1)), *sums).collect():  # one row a language, five at most
        found[row[0]] = (row[1], list(row[2:]))
    if found:
        every = [sum(x) for x in zip(*[sums for _, sums in found.values()])]
        found[""] = (sum(n for n, _ in found.values()), every)
    return {name: ([x // n for x in sums[:6]], [x // n for x in sums[6:]]) for name, (n, sums) in found.items()}


def jensen_shannon(shares: Column, reference: Column) -> Column:
    """The distance, between 0 and 1, of two histograms in millionths."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(shares, reference, lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total / (2 * UNIT), F.lit(0.0)))


def judge(measured: DataFrame, known: dict, max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Adds class_distance, word_distance, base_failed and kept to measured rows."""
    told = measured.select("*", *_distances(known, max_word))
    if known:
        told = told.select("*", "_both.*").drop("_both")
    failed = _base_failed()
    near = (F.coalesce("class_distance", F.lit(0.0)) <= max_class) & (F.coalesce("word_distance", F.lit(0.0)) <= max_word)
    return told.withColumn("base_failed", failed).withColumn("kept", ~failed & near)


def rules(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", **limits: float) -> DataFrame:
    """doc_id, the counts, class_distance, word_distance, base_failed and kept for every row.

    Measures are narrow and are written, so that every text is read once.
    """
    measured = materialise(measure(docs, text, lang, carried=F.col(id)), "measures")
    told = judge(measured, references(measured), **limits).withColumnRenamed("_row", "doc_id")
    return told.drop("_lang", "_text", "n_chars", "classes", "words", "words_by")


def drop_low_quality(docs: DataFrame, text: str = "text", lang: str = "lang", **limits: float) -> DataFrame:
    """docs, all columns, without the rows that the rules reject.

    Texts are measured twice, for the references and for the verdicts, and rows are kept
    where they stand: no row is shuffled, and nothing is joined.
    """
    known = references(measure(docs, text, lang))
    return judge(measure(docs, text, lang, carried=F.struct("*")), known, **limits).filter("kept").select("_row.*")


def _distances(known: dict[str, tuple[list[int], list[int]]], max_word: float) -> list[Column]:
    """Distances where the text has the least lengths, else null.

    A row without a known language belongs to the nearest language by its words. If none is
    within the limit there is no distance of words, and classes are held against all documents.
    """
    if not known:
        return [F.lit(None).cast("double").alias("class_distance"), F.lit(None).cast("double").alias("word_distance")]
    numbers = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    pick = lambda lang, k: _pick(lang, {name: numbers(x[k]) for name, x in known.items() if name}, numbers(known[""][k]))
    guesses = [
        F.struct(jensen_shannon(F.col("words_by")[place], numbers(known[name][1])).alias("far"), F.lit(name).alias("lang"))
        for place, name in enumerate(COMMON_WORDS)
        if name in known
    ]
    none = F.lit(None).cast("struct<far double, lang string>")
    guess = F.array_min(F.array(*guesses)) if guesses else none
    guess = F.when((F.col("_lang") == "") & (F.col("n_words") >= MIN_WORDS_FOR_COMMON), guess).otherwise(none)
    own = F.struct(jensen_shannon(F.col("words"), pick(F.col("_lang"), 1)).alias("far"), F.col("_lang").alias("lang"))
    own = F.when(F.col("n_words") >= MIN_WORDS_FOR_COMMON, own).otherwise(F.struct(F.lit(None).cast("double").alias("far"), F.col("_lang").alias("lang")))
    fits = lambda g: F.when(g["far"] <= max_word, g).otherwise(F.struct(F.lit(None).cast("double").alias("far"), F.lit("").alias("lang")))
    judged = F.when(F.col("_lang") == "", _bind(guess, fits)).otherwise(own)
    classes = lambda j: F.when(F.col("n_chars") >= MIN_CHARS_FOR_CLASSES, jensen_shannon(F.col("classes"), pick(j["lang"], 0)))
    both = _bind(judged, lambda j: F.struct(classes(j).alias("class_distance"), j["far"].alias("word_distance")))
    return [settled(both).alias("_both")]
