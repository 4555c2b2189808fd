"""Secret scan: candidate strings, and a random forest that removes false
positives.

DataFrame functions and Spark's own RandomForestClassifier only. A candidate
is the whole value after a credential's name (quoted: up to the closing quote
of the line; else what is not blank, without closing punctuation), a run of 8
or more letters, digits and ``+/_-`` with a digit in it, or a key of a
provider's format without any digit. Its features: length, shares of character kinds, character transitions (changes of
kind, and how likely its letter pairs are in the corpus' own words), entropy,
dictionary coverage (share of its characters in runs of 3 or more letters that
are words of at least ``MIN_DOCS`` documents, counted over all documents), its
path (the document's source) and the neighbouring words, the last two as the
share of true findings among labelled ones with the same value, smoothed.

Labelled findings are an argument (``doc_id``, ``start``, ``label`` 1 = true).
Without them rules label the clear cases: a provider's key format is true, and
so is a value assigned to a credential's name if it is quoted or such a run;
digits with separators, parts of addresses, ordinary words with a number, and
unquoted dictionary words or numbers after a name are false; others have no
label.
Training uses at most ``max_labels`` labelled rows, up to half of them of each
label (those of the smallest hash), so rare secrets are not crowded out by
numbers; both labels weigh the same in the fit. Of each label two fifths give
the shares, two fifths fit the forest, one fifth is held out for ``accuracy``.
Every candidate is judged.

Word counts combine before the shuffle, so a common word is one row per task.
Only bounded tables (by ``max_labels``) are broadcast.

Defined results: null and empty texts have no candidates; a null source is a
path of its own; repeated rows each give their findings; an empty table gives
none; without labels of both kinds the labels alone decide, and what has none
is no secret; texts are scanned whole; a U+0001 in a text counts as white space, and ``redact`` turns
it into a space where it changes a text; other columns are ignored (``redact``
keeps them)."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indtables.llm.common import cut
from indtables.llm.lexical import LOWER, UPPER, entropy, rates, sample, share, with_rates

SEP = "\u0001"
CONTEXT = 48
MIN_DOCS = 5
MAX_LABELS = 20_000
TREES, DEPTH = 16, 5
# Public key formats, and names that credentials are given.
KEYS = r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})"
KEY_FORMAT = f"^{KEYS}$"
NAME = r"(?i:password|passwd|pwd|token|secret|api[_-]?key|credential)[sS]?"
NAMED = NAME + r"[\"']?\s*[=:]+\s*[\"']?$"
# The three kinds of candidates: what precedes a named value is group 1 (the
# name itself is looked back at, it may end a run), the values are groups 2-4.
# Looking back costs, so it is done at an assignment only.
RUN = rf"(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{{8,}}(?:(?<!{NAME})={{1,2}})?"
_QUOTED = r"""(?<=")[^"\n][^\n]*?(?=(?<!\\)")|(?<=')[^'\n][^\n]*?(?=(?<!\\)')"""
_BARE = r"""[^\s"']\S*(?<![,;.)\]}"'])"""
_START = r"(?<![A-Za-z0-9+/_\-])"
CANDIDATE = (
    rf"((?=[=:])(?<={NAME}[\"']?\s{{0,{CONTEXT}}})[=:]++\s*+[\"']?+)({_QUOTED}|{_BARE})"
    rf"|{_START}({RUN})"
    rf"|{_START}({KEYS})(?![A-Za-z0-9])"
)
PATHS = ["path", "word_before", "word_after"]
FEATURES = [
    "n_chars", "digit_share", "upper_share", "lower_share", "transitions", "pair_likelihood", "char_entropy",
    "coverage", "assigned", "quoted", "path_rate", "word_before_rate", "word_after_rate",
]


def scanned(text: Column) -> Column:
    return F.translate(text, SEP, " ")


def marked(text: Column) -> Column:
    """The text as an array: odd places are candidates, even ones what stands
    between them; joined, they are the text."""
    return F.split(F.regexp_replace(scanned(text), CANDIDATE, f"$1{SEP}$2$3$4{SEP}"), SEP)


def candidates(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per candidate with its place and context."""
    parts = (
        docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("path"),
                    F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
        .filter(scanned(F.col("text")).rlike(CANDIDATE))
        .withColumn("parts", marked(F.col("text")))
    )
    # place and start of every part in one pass over the array
    ends = F.aggregate(
        "parts", F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.length(p)))
    )
    at = F.sequence(F.lit(2), F.size("parts"), F.lit(2))
    rows = parts.withColumn("ends", ends).select(
        "id", F.coalesce("path", F.lit("")).alias("path"), "text_hash", F.explode(at).alias("place"), "parts", "ends"
    )
    part = lambda d: F.element_at("parts", F.col("place") + d)
    return rows.select(
        "id", "path", "text_hash", "place", F.element_at("ends", F.col("place")).cast("long").alias("start"),
        part(0).alias("value"), F.substr(part(-1), -F.least(F.length(part(-1)), F.lit(CONTEXT))).alias("before"),
        F.substr(part(1), F.lit(1), F.lit(CONTEXT)).alias("after"),
    )


def dictionary(docs: DataFrame, text_col: str) -> DataFrame:
    """(run, n_docs): lower-case words of 3 letters or more of at least
    ``MIN_DOCS`` documents, over all documents."""
    words = F.array_distinct(F.split(F.translate(F.col(text_col), UPPER, LOWER), r"[^\p{L}]+"))
    return (
        docs.select(F.explode(words).alias("run")).filter(F.length("run") >= 3)
        .groupBy("run").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") >= MIN_DOCS)
    )


def pair_table(words: DataFrame) -> DataFrame:
    """(pair, log_p): how likely each letter pair is, a-z, from the
    dictionary's words: at most 676 rows."""
    pairs = words.select(
        F.explode(F.expr("transform(sequence(1, length(run) - 1), i -> substr(run, i, 2))")).alias("pair"), "n_docs"
    ).filter(F.col("pair").rlike("^[a-z]{2}$"))
    found = cut(pairs.groupBy("pair").agg(F.sum("n_docs").alias("n")), "secret-pairs")
    total = found.agg(F.sum("n")).first()[0] or 1
    return found.select("pair", F.log(F.col("n") / F.lit(total)).alias("log_p"))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    value, lower = F.col("value"), F.translate("value", UPPER, LOWER)
    kinds = r"(?<=[0-9])(?=[^0-9])|(?<=[A-Z])(?=[^A-Z])|(?<=[a-z])(?=[^a-z])|(?<=[+/_\-=])(?=[^+/_\-=])"
    plain = {
        "n_chars": F.length(value), "digit_share": share(value, "0-9"), "upper_share": share(value, "A-Z"),
        "lower_share": share(value, "a-z"), "transitions": F.regexp_count(value, F.lit(kinds)) / F.length(value),
        "char_entropy": entropy(value), "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("int"),
        "quoted": (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("int"),
    }
    around = {
        "word_before": F.lower(F.regexp_extract("before", r"(\p{L}+)[^\p{L}]*$", 1)),
        "word_after": F.lower(F.regexp_extract("after", r"^[^\p{L}]*(\p{L}+)", 1)),
    }
    out = found.withColumns({k: v.cast("double") for k, v in plain.items()} | around)
    # a value's own features once per value
    runs = found.select("value").distinct().withColumn(
        "run", F.explode(F.array_distinct(F.regexp_extract_all(F.translate("value", UPPER, LOWER), F.lit("([a-z]{3,})"))))
    )
    covered = (
        runs.join(words, "run").groupBy("value")
        .agg(F.sum(F.length("run")).alias("covered"))
        .withColumn("coverage", F.least(F.col("covered") / F.length("value"), F.lit(1.0)))
    )
    pairs = found.select("value").distinct().withColumn(
        "pair", F.explode(F.transform(F.sequence(F.lit(1), F.length(lower) - 1), lambda i: F.substr(lower, i, F.lit(2))))
    ).filter(F.col("pair").rlike("^[a-z]{2}$"))
    likely = (
        pairs.join(F.broadcast(pair_table(words)), "pair", "left")
        .groupBy("value").agg(F.avg(F.coalesce("log_p", F.lit(-12.0))).alias("pair_likelihood"))
    )
    out = out.join(covered.select("value", "coverage"), "value", "left").join(likely, "value", "left")
    return out.fillna(0.0, ["coverage"]).fillna(-15.0, ["pair_likelihood"])


def rule_labels(found: DataFrame) -> DataFrame:
    """``label`` of the clear cases, null elsewhere."""
    value, named, quoted = F.col("value"), F.col("before").rlike(NAMED), F.col("quoted") == 1
    bare = named & ~quoted & ~value.rlike(f"^{RUN}$")
    true = value.rlike(KEY_FORMAT) | (named & ~bare)
    plain = (F.col("coverage") >= 1) | value.rlike("^[0-9.,:]+$")
    false = (
        value.rlike(r"^[0-9+/_\-=]+$") | F.col("before").rlike("[@.]$") | F.col("after").rlike("^[@.][A-Za-z0-9]")
        | value.rlike("^[A-Za-z][a-z]+[0-9]{1,4}$")
    )
    return found.withColumn("label", F.when(true, 1).when(bare, F.when(plain, 0)).when(false, 0))


class Forest:
    """Trained forest and its shares of true findings."""

    def __init__(self, labelled: DataFrame, max_labels: int = MAX_LABELS):
        found = labelled.filter(F.col("label").isNotNull())
        found = cut(sample(found, ["id", "start", "value"], max_labels), "secret-labels")
        self.tables = {c: cut(rates(found.filter(F.col("fold") < 2), c), f"secret-{c}") for c in PATHS}
        ready = self.vectors(found.filter(F.col("fold") >= 2)).select("features", "label", "weight", "fold")
        ready = cut(ready.coalesce(4), "secret-training")  # at most max_labels rows
        fit = ready.filter(F.col("fold") < 4)
        self.held, self.model = ready.filter(F.col("fold") == 4), None
        if fit.select("label").distinct().count() == 2:
            self.model = RandomForestClassifier(
                labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, subsamplingRate=0.8, seed=42
            ).fit(fit)

    def vectors(self, df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_rates(df, self.tables))

    def judge(self, df: DataFrame) -> DataFrame:
        """Adds ``score`` and ``is_secret``."""
        if self.model is None:
            score = F.coalesce(F.col("label").cast("double"), F.lit(0.0))
            return df.withColumn("score", score).withColumn("is_secret", F.col("score") >= 0.5)
        out = self.model.transform(self.vectors(df)).withColumn("score", vector_to_array("probability")[1])
        return out.withColumn("is_secret", F.col("score") >= 0.5)

    def accuracy(self) -> float | None:
        """Balanced accuracy on the held-out fifth."""
        if self.model is None:
            return None
        right = self.model.transform(self.held).withColumn("right", (F.col("prediction") == F.col("label")).cast("int"))
        return right.groupBy("label").agg(F.avg("right").alias("r")).agg(F.avg("r")).first()[0]


def _findings(docs, labels, id_col, text_col, source_col, max_labels) -> DataFrame:
    found = cut(candidates(docs, id_col, text_col, source_col), "secret-candidates")
    words = cut(dictionary(docs, text_col), "secret-words")
    ready = features(found, words)
    if labels is None:
        ready = rule_labels(ready)
    else:
        given = labels.select(F.col("doc_id").alias("id"), "start", "label").dropDuplicates(["id", "start"])
        ready = ready.join(given, ["id", "start"], "left")
    ready = cut(ready, "secret-features")
    return Forest(ready, max_labels).judge(ready)


def findings(
    docs: DataFrame,
    labels: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    max_labels: int = MAX_LABELS,
) -> DataFrame:
    """One row per candidate: id, start and length (characters), the value's
    hash, label (null where unlabelled), score, is_secret."""
    return _findings(docs, labels, id_col, text_col, source_col, max_labels).select(
        F.col("id").alias(id_col), "start", F.length("value").cast("long").alias("n_chars"),
        F.sha2("value", 256).alias("value_sha256"), "label", "score", "is_secret",
    )


def redact(
    docs: DataFrame,
    labels: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    max_labels: int = MAX_LABELS,
    mask: str = "[SECRET]",
) -> DataFrame:
    """The documents, same rows and columns, each secret replaced by ``mask``.
    Only documents with a candidate are shuffled."""
    found = _findings(docs, labels, id_col, text_col, source_col, max_labels)
    hits = cut(
        found.filter("is_secret").groupBy("id", "text_hash").agg(F.collect_set(F.col("place") - 1).alias("places")),
        "secret-hits",
    )
    some = F.coalesce(scanned(F.col(text_col)).rlike(CANDIDATE), F.lit(False))
    rows = docs.filter(some).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("own_id"), F.xxhash64(text_col).alias("own_hash"), F.col(text_col).alias("text"),
    )
    joined = rows.join(hits, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    clean = F.array_join(
        F.transform(marked(F.col("text")), lambda p, i: F.when(F.array_contains("places", i), mask).otherwise(p)), ""
    )
    text = F.when(F.col("places").isNull(), F.col("text")).otherwise(clean)
    changed = joined.select(*[
        text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns
    ])
    return docs.filter(~some).unionByName(changed)
