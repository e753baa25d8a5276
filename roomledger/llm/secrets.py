"""Secret scans: candidates by form, false positives removed by a random forest.

Candidates are runs of token characters with a digit. A forest, trained from labelled findings, looks
at their length, the changes between character classes, how much of them dictionary words cover,
signs of a path, and the neighbouring words. Everything is DataFrame functions and Spark ML.

The forest is fitted on a bounded sample: at most `Settings.training` different findings of either
label, those with the smallest hashes. Candidates, their features and decisions cover all texts.

Defined results: null and empty texts have no candidates. Repeated rows are answered alike. A table
without candidates, or with findings of one label only, has no model: then the labels themselves
decide. Columns other than the id and the text are carried, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.functions.text import let
from roomledger.llm.common import stored, text_of

#: A run of at least 12 token characters that has a digit. An equals sign ends a run, so that NAME=value has
#: the value as a run of its own; it is part of one only as padding, with no value or quote behind it.
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{12,}"
    r"(?:={1,2}(?![A-Za-z0-9+/_=\"'-]))?"
)
#: Least length of a candidate.
LEAST = 12
#: Characters that are looked at before and after a candidate.
BEFORE, AFTER = 48, 24

# Words that name a credential, forms of well-known keys, and dictionary words.
NAMES = r"(?i)(?:key|token|secret|passw(?:or)?d|pwd|auth|credential|bearer|api[_ -]?key)"
FORMS = r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}"
DICTIONARY = (
    "access account action address article author backup build cache change class client code comment "
    "common config content control copyright country create data date default delete design detail "
    "document download edition element email error event example export external field file folder "
    "format function general global group header history home html http image import index info input "
    "internal issue item java json language level library license line link list local login manager "
    "media member menu message method model module name network news node number object option order "
    "output package page part patch path photo plugin point policy post price private product profile "
    "program project public query read record release report request resource result sample schema "
    "script search section server service session setting share site source stand start state status "
    "stock storage string style summary support system table target test text thread time title topic "
    "type update upload user value version video view volume week window word year"
).split()


@dataclass(frozen=True)
class Settings:
    #: Largest number of different findings of either label that the forest is fitted on.
    training: int = 2000
    trees: int = 20
    depth: int = 6
    threshold: float = 0.5
    seed: int = 7


FEATURES = (
    "length", "digits", "uppers", "lowers", "changes", "letter_digit", "kinds", "hex", "covered",
    "path", "after_slash", "named", "assigned", "quoted", "word_before", "word_after",
)


def with_candidates(docs: DataFrame) -> DataFrame:
    """The rows as `row` with `_row` and `cands`: (text, before, after, gap) of every candidate.

    `before` and `after` are of the whole text: other candidates near by are part of them.
    """
    near = lambda items, i: F.coalesce(F.get(items, i), F.lit(""))

    def around(x: Column, i: Column, c: Column) -> Column:
        # So many candidates and the gaps between them fill the length that is looked at.
        back, ahead = -(-BEFORE // LEAST), -(-AFTER // LEAST)
        before = [p for k in range(back, 0, -1) for p in (near(x["tails"], i - k), near(x["found"], i - k))]
        after = [p for k in range(1, ahead + 1) for p in (near(x["heads"], i + k), near(x["found"], i + k))]
        return F.struct(
            c.alias("text"),
            F.right(F.concat(*before, near(x["tails"], i)), F.lit(BEFORE)).alias("before"),
            F.left(F.concat(*after, near(x["heads"], i + ahead + 1)), F.lit(AFTER)).alias("after"),
            F.get(x["sizes"], i).alias("gap"),
        )

    def cands(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0))
        cut = F.struct(found.alias("found"), F.split(t, CANDIDATE).alias("gaps"))
        ends = lambda x: F.struct(
            x["found"].alias("found"),
            F.transform(x["gaps"], lambda g: F.right(g, F.lit(BEFORE))).alias("tails"),
            F.transform(x["gaps"], lambda g: F.left(g, F.lit(AFTER))).alias("heads"),
            F.transform(x["gaps"], lambda g: F.length(g)).alias("sizes"),
        )
        return let(cut, lambda g: let(ends(g), lambda x: F.transform(x["found"], lambda c, i: around(x, i, c))))

    return docs.select(
        F.struct("*").alias("row"), F.monotonically_increasing_id().alias("_row"),
        let(text_of(docs), lambda t: F.when(t.rlike(CANDIDATE), cands(t))).alias("cands"),
    )


def findings(rows: DataFrame) -> DataFrame:
    """One row per candidate: _row, its place in the list, and its texts."""
    return rows.where("cands is not null").select("_row", F.posexplode("cands").alias("place", "c")).select(
        "_row", "place", "c.*"
    )


def with_features(found: DataFrame) -> DataFrame:
    """The numbers that the forest looks at; shares are of the candidate's length."""
    text, before, after = F.col("text"), F.col("before"), F.col("after")
    n = F.length(text).cast("double")
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / n
    yes = lambda condition: condition.cast("double")
    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    return found.select(
        "*",
        n.alias("length"), share("[0-9]").alias("digits"), share("[A-Z]").alias("uppers"),
        share("[a-z]").alias("lowers"),
        share("[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])").alias("changes"),
        share("[A-Za-z](?=[0-9])").alias("letter_digit"),
        (F.size(F.array_distinct(F.split(text, ""))) / n).alias("kinds"),
        yes(text.rlike("^[0-9a-fA-F]+$")).alias("hex"),
        (1 - F.length(F.regexp_replace(F.lower(text), words, "")) / n).alias("covered"),
        share("[/_-]").alias("path"),
        yes(before.rlike(r"[/.@\\]$") | after.rlike(r"^[/.@\\]\w")).alias("after_slash"),
        yes(before.rlike(NAMES + r"\w*\W{0,6}$")).alias("named"),
        yes(before.rlike(r"[=:]\s*[\"']?$")).alias("assigned"),
        yes(before.rlike(r"[\"']$") & after.rlike(r"^[\"']")).alias("quoted"),
        yes(before.rlike(r"[A-Za-z]{2,}[ ,.]{1,2}$")).alias("word_before"),
        yes(after.rlike(r"^[ ,.]{1,2}[A-Za-z]{2,}")).alias("word_after"),
    )


def rule_label(found: DataFrame) -> DataFrame:
    """Labels for findings that no one has labelled: 1 for a known form of key, or a value that mixes
    letters and digits and is assigned to the name of a credential; 0 for the others."""
    text, before = F.col("text"), F.col("before")
    named = before.rlike(NAMES + r"\w*\s*[=:]+\s*[\"']?$") & text.rlike("[A-Za-z]")
    return found.withColumn("label", (text.rlike(f"^(?:{FORMS})$") | named).cast("double"))


def trained(labelled: DataFrame, settings: Settings = Settings()):
    """The forest, or None where there are not both labels."""
    each = []
    for label in (0.0, 1.0):
        kinds = labelled.where(F.col("label") == label).groupBy("text").agg(
            F.min_by(F.struct(*FEATURES, "label"), F.struct("before", "after")).alias("f")
        )
        # A bounded sample: the findings with the smallest hashes.
        each.append(kinds.orderBy(F.xxhash64("text"), "text").limit(settings.training).select("f.*"))
    sample = stored(each[0].union(each[1]).coalesce(1).sortWithinPartitions("label", *FEATURES), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    return RandomForestClassifier(
        numTrees=settings.trees, maxDepth=settings.depth, seed=settings.seed
    ).fit(data.select("features", "label"))


def decided(rows: DataFrame, labelled: DataFrame | None = None, settings: Settings = Settings()) -> DataFrame:
    """(_row, spans): for every row with candidates, an array of (place, start, length, score, secret).

    `rows` is a stored table of with_candidates(). `labelled` has labelled findings with the columns
    of findings() and `label`; without it the rule's labels over all rows are used.
    """
    found = rule_label(with_features(findings(rows)))
    model = trained(with_features(labelled) if labelled is not None else found, settings)
    if model is None:
        scored = found.withColumn("score", F.col("label"))
    else:
        scored = model.transform(
            VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
        ).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    # The running sum of gaps and candidates of a text gives the ends.
    size = F.length("text")
    end = F.sum(F.col("gap") + size).over(Window.partitionBy("_row").orderBy("place"))
    span = F.struct(
        "place", (end - size).cast("long").alias("start"), size.alias("length"),
        F.round("score", 6).alias("score"), (F.col("score") >= settings.threshold).alias("secret"),
    )
    return scored.select("_row", span.alias("span")).groupBy("_row").agg(
        F.sort_array(F.collect_list("span")).alias("spans")
    )


def scanned(docs: DataFrame, id_column: str = "doc_id", labelled: DataFrame | None = None) -> DataFrame:
    """One row per document: number of candidates and of secrets, and the secrets' spans and scores."""
    rows = stored(
        with_candidates(docs.select(docs[id_column].alias("doc_id"), text_of(docs).alias("text")))
        .select(F.col("row.doc_id").alias("doc_id"), "_row", "cands"),
        "secret-rows",
    )
    joined = rows.join(decided(rows, labelled), "_row", "left")
    kept = F.transform(
        F.filter("spans", lambda x: x["secret"]),
        lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"), x["score"].alias("score")),
    )
    none = F.expr("cast(array() as array<struct<start:bigint,length:int,score:double>>)")
    return joined.select(
        "doc_id", F.coalesce(F.size("cands"), F.lit(0)).cast("long").alias("n_candidates"),
        F.coalesce(kept, none).alias("secrets"),
    ).withColumn("n_secrets", F.size("secrets").cast("long"))


MASK = "[SECRET]"


def masked(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The documents with every secret replaced by a mask; the count of characters follows the text.

    Only texts with candidates take part in an exchange.
    """
    rows = stored(with_candidates(docs), "secret-rows")
    joined = rows.where("cands is not null").join(
        decided(rows.select("_row", "cands"), labelled), "_row"
    )

    def replaced(gaps: Column) -> Column:
        pieces = F.zip_with(
            "cands", "spans", lambda c, s: F.when(s["secret"], F.lit(MASK)).otherwise(c["text"])
        )
        return F.array_join(
            F.flatten(F.zip_with(gaps, pieces, lambda g, p: F.array(g, F.coalesce(p, F.lit(""))))), ""
        )

    hit = F.exists("spans", lambda s: s["secret"])
    text = F.when(hit, let(F.split("row.text", CANDIDATE), replaced)).otherwise(F.col("row.text"))
    changed = joined.select(F.col("row").withField("text", text).alias("row"), hit.alias("hit"))
    if "n_chars" in docs.columns:
        count = F.when(F.col("hit"), F.length("row.text").cast("long")).otherwise(F.col("row.n_chars"))
        changed = changed.select(F.col("row").withField("n_chars", count).alias("row"))
    return rows.where("cands is null").select("row.*").union(changed.select("row.*"))
