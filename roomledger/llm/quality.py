"""Quality rules: a document's histograms against those of its language.

Every document has two histograms: its characters by class and its common words by word. The
reference of a language is the sum over all documents that carry its name. A document is rejected
when one of the two is too far from the reference by the Jensen-Shannon distance; a histogram of few
characters or words is not judged. Basic counts reject as well.

Defined results: null and empty texts have no words and fail the basic rule. A null language is a
language of its own. A reference of fewer words than a document needs is not used. Repeated rows
are judged alike. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.functions.text import let
from roomledger.llm.common import stored, text_of, words_of

# Frequent short words of English, German, French and Spanish.
COMMON_WORDS = tuple(sorted(set("""
the of and to a in that is was for it with as his on be at by this are from or an which you he
der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es an wie
de la le et les des en un une du que est pour qui dans par plus pas au sur ne se avec son
el los las y del con por una su para lo como más pero sus al no ha si sin
""".split())))


@dataclass(frozen=True)
class Limits:
    """What the rules allow."""

    least_words: int = 10
    repeat_percent: int = 20
    window: int = 5
    #: Largest distance of the character classes, judged from so many characters on.
    class_distance: float = 0.32
    class_chars: int = 200
    #: Largest distance of the common words, judged from so many words on.
    word_distance: float = 0.29
    word_words: int = 100
    #: A reference needs so many words.
    reference_words: int = 1000


CLASSES = ("letter", "upper", "digit", "symbol", "mark", "space")


def _histograms(text: Column, words: Column) -> list[Column]:
    """Counts by class, and the common words with their counts in order of the alphabet."""
    n_chars = F.length(text)
    word_chars = F.length(F.array_join(words, ""))
    upper = F.regexp_count(text, F.lit(r"\p{Lu}"))
    digit = F.regexp_count(text, F.lit(r"[0-9]"))
    symbol = F.regexp_count(text, F.lit(r"[#*$%&|<>]"))
    mark = F.regexp_count(text, F.lit(r"""[!"'()+,./:;=?@\[\]^_`{}~-]"""))
    classes = F.array(
        *(c.cast("double") for c in (
            word_chars - upper - digit - symbol - mark, upper, digit, symbol, mark,
            n_chars - word_chars,
        ))
    )
    found = F.sort_array(
        F.transform(
            F.filter(words, lambda w: F.lower(w).isin(*COMMON_WORDS)), lambda w: F.lower(w)
        )
    )

    def counted(s: Column) -> Column:
        # Equal words stand together, so the first place of the next word gives the count.
        kinds = F.array_distinct(s)
        return let(
            F.transform(kinds, lambda w: F.array_position(s, w)),
            lambda first: F.zip_with(
                kinds,
                F.zip_with(
                    first,
                    F.concat(F.slice(first, 2, F.size(first)), F.array(F.size(s) + F.lit(1).cast("long"))),
                    lambda a, b: (b - a).cast("double"),
                ),
                lambda w, n: F.struct(w.alias("word"), n.alias("n")),
            ),
        )

    return [
        word_chars.cast("long").alias("word_chars"),
        symbol.cast("long").alias("n_symbols"),
        classes.alias("classes"),
        let(found, lambda s: F.when(F.size(s) > 0, counted(s)).otherwise(
            F.expr("cast(array() as array<struct<word:string,n:double>>)")
        )).alias("common"),
    ]


def _repeated(words: Column, window: int) -> Column:
    """Words inside windows that stand twice or more in the text.

    Windows are compared by their 64-bit hashes.
    """

    def covered(places: Column) -> Column:
        gap = F.zip_with(
            places, F.slice(places, 2, F.size(places)),
            lambda a, b: F.coalesce(F.least(b - a, F.lit(window)), F.lit(window)),
        )
        return F.aggregate(gap, F.lit(0), lambda x, y: x + y)

    def places(sorted_: Column) -> Column:
        same = lambda k, j: F.get(sorted_, k)["h"] == F.get(sorted_, j)["h"]
        kept = F.filter(
            sorted_,
            lambda p, k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)),
        )
        return F.sort_array(F.transform(kept, lambda p: p["i"]))

    def of_hashes(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(
                F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
                lambda s: let(places(s), covered),
            )
        )

    return F.when(F.size(words) < window + 1, F.lit(0)).otherwise(
        let(
            F.transform(
                F.sequence(F.lit(1), F.size(words) - (window - 1)),
                lambda i: F.xxhash64(F.slice(words, i, window)),
            ),
            of_hashes,
        )
    )


def _with_row(docs: DataFrame, fields) -> DataFrame:
    """The columns as `row`, and the fields of one struct beside them."""
    frame = docs.select(
        F.struct("*").alias("row"), docs["lang"].alias("lang"), let(
            text_of(docs), lambda t: let(words_of(t), lambda w: F.struct(*fields(t, w)))
        ).alias("f"),
    )
    return frame


def reference(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per language: shares of the character classes and of the common words.

    All documents count. The sums are taken before the exchange, so a language of any size costs a
    row per task and bin.
    """
    frame = _with_row(docs, lambda t, w: [F.size(w).alias("n_words"), *_histograms(t, w)])
    bins = F.concat(
        F.array(*(F.struct(F.lit(f"class {c}").alias("bin"), F.col("f.classes")[i].alias("n")) for i, c in enumerate(CLASSES))),
        F.array(F.struct(F.lit("words").alias("bin"), F.col("f.n_words").cast("double").alias("n"))),
        F.transform("f.common", lambda x: F.struct(F.concat(F.lit("word "), x["word"]).alias("bin"), x["n"].alias("n"))),
    )
    counts = (
        frame.select("lang", F.explode(bins).alias("b"))
        .groupBy("lang", "b.bin").agg(F.sum("b.n").alias("n"))
        .groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("bins"))
    )
    n = lambda name: F.coalesce(F.element_at("bins", F.lit(name)), F.lit(0.0))
    chars = sum((n(f"class {c}") for c in CLASSES[1:]), n(f"class {CLASSES[0]}"))
    return counts.where(n("words") >= limits.reference_words).select(
        F.col("lang").alias("ref_lang"),
        F.array(*(n(f"class {c}") / chars for c in CLASSES)).alias("ref_classes"),
        F.array(*(n(f"word {w}") / n("words") for w in COMMON_WORDS)).alias("ref_words"),
    )


def _term(p: Column, q: Column) -> Column:
    """What a bin adds to twice the divergence, in bits."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    return part(p, (p + q) / 2) + part(q, (p + q) / 2)


def _distance(shares: Column, references: Column) -> Column:
    """The Jensen-Shannon distance of two arrays of shares."""
    terms = F.zip_with(shares, references, _term)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda x, y: x + y) / 2, F.lit(0.0)))


def judged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Every row as `row`, its counts, the two distances, `base_failed` and `kept`.

    The references are stored first. They are a row per language, so the join that follows is
    small; should there be very many languages, Spark joins by exchange and splits frequent ones.
    """
    references = stored(reference(docs, limits), "quality-reference")
    frame = _with_row(
        docs,
        lambda t, w: [
            F.size(w).cast("long").alias("n_words"),
            *_histograms(t, w),
            let(
                F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                lambda x: F.size(x) - F.size(F.array_distinct(x)),
            ).cast("long").alias("n_dup_lines"),
            _repeated(w, limits.window).cast("long").alias("n_repeat_words"),
        ],
    ).join(references, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    n_chars = F.aggregate("f.classes", F.lit(0.0), lambda x, y: x + y)
    classes = F.when(
        F.col("ref_classes").isNotNull() & (n_chars >= limits.class_chars),
        _distance(F.transform("f.classes", lambda x: x / n_chars), F.col("ref_classes")),
    )
    index = F.create_map(*(F.lit(x) for i, w in enumerate(COMMON_WORDS) for x in (w, i)))
    n_words = F.col("f.n_words").cast("double")
    # Bins that the document lacks add q each; the words that are not common are one more bin.
    common = F.aggregate(
        "f.common",
        F.struct(F.lit(0.0).alias("terms"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q")),
        lambda s, x: let(
            F.struct((x["n"] / n_words).alias("p"), F.get("ref_words", F.element_at(index, x["word"])).alias("q")),
            lambda y: F.struct(
                (s["terms"] + _term(y["p"], y["q"])).alias("terms"), (s["p"] + y["p"]).alias("p"), (s["q"] + y["q"]).alias("q")
            ),
        ),
    )
    all_q = F.aggregate("ref_words", F.lit(0.0), lambda x, y: x + y)
    words = F.when(
        F.col("ref_words").isNotNull() & (n_words >= limits.word_words),
        let(
            common,
            lambda s: F.sqrt(
                F.greatest((s["terms"] + (all_q - s["q"]) + _term(1 - s["p"], 1 - all_q)) / 2, F.lit(0.0))
            ),
        ),
    )
    f = F.col("f")
    base = (f["n_words"] < limits.least_words) | (100 * f["n_repeat_words"] > limits.repeat_percent * f["n_words"])
    far = F.coalesce(classes > limits.class_distance, F.lit(False)) | F.coalesce(words > limits.word_distance, F.lit(False))
    return frame.select(
        "row", "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines", "f.n_repeat_words",
        F.round(classes, 6).alias("class_distance"), F.round(words, 6).alias("word_distance"),
        base.alias("base_failed"), (~base & ~far).alias("kept"),
    )


def kept(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, with all their columns.

    The test holds a row number, so that Spark does not push it down into the counts and compute them again.
    """
    passed = F.when(F.monotonically_increasing_id() >= 0, F.col("kept"))
    return judged(docs, limits).select("row", "kept").where(passed).select("row.*")
