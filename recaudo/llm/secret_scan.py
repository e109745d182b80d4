r"""Secret scan with a random forest that removes false positives.

Candidates are runs of 16 or more letters, digits, ``+ / _ -`` and values of
six or more characters that are assigned to a name like password or token,
which a suffix (``_PROD``) and a closing quote may follow. A value goes to its
closing quote in the line, or to white space; a run inside a longer value is a
candidate too. Each gets
features: length; shares of upper-case letters, digits and other characters;
transitions between character classes a character; coverage by the corpus'
own dictionary (share of its three-letter sequences that are among the
``dictionary`` most frequent of all words); whether it stands in a path; and
its neighbouring words (a name of a secret before it, an assignment, quotes,
words of documentation around it). A random forest over them gives the chance
that a finding is a secret.

The forest learns from labelled findings (:func:`label_findings`, or a table
of the caller's): 1 for keys of a published format and for values assigned to
a secret's name that mix letters and digits, 0 for plain words, numbers and
placeholders; findings that no rule labels are left to the forest. At most
``max_train`` different findings are used, a documented bound.

Only DataFrame functions and Spark's DataFrame forest. Trigrams are counted
with partial sums; the dictionary (``dictionary`` rows) is the only thing
broadcast. A finding is a row, so a document with very many of them is split
where the row count needs it.

Null text counts as empty and has no findings. Repeated rows give their
findings each. A null source is no path. Without labelled findings of both
kinds every finding is kept with score 0.5. Other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from recaudo.session import scratch_path

from .common import read_table, text_of, written
from .registry import register
from .spans import match_spans

NAMES = r"passw(?:or)?d|pwd|secret|token|api[_-]?key|access[_-]?key|credential"
SUFFIX = r"(?:[0-9_.-][A-Za-z0-9_.-]{0,23}+)?+"
#: Runs of 16 or more key characters, and values that are assigned to a secret's name.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+"
LEAD = rf"(?i:{NAMES}){SUFFIX}[\x22']?\s{{0,2}}[=:]\s{{0,2}}[\x22']?+"
# to the quote that opened it, where the line has it, else to white space or a quote
ASSIGNED = LEAD + (r"(?:(?<=\x22)(?!.{0,5}(?<!\\)\x22).{6,}?(?=(?<!\\)\x22)|(?<=')(?!.{0,5}(?<!\\)').{6,}?(?=(?<!\\)')"
                   r"|[^\s\x22']{6,}+(?:'(?![\s,;)}\]]|$)[^\s\x22']++)*+)")
#: Published key formats (fixed values).
FORMATS = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})$"
PLACEHOLDER = r"(?i)example|placeholder|changeme|your[_-]|xxxx|dummy|sample|0123456789|(.)\1{7}"
CONTEXT = 40
FEATURES = ("length", "upper", "digit", "other", "transitions", "coverage", "in_path", "named", "assigned", "quoted", "documentation")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source") -> DataFrame:
    """doc_id, path, start, end, value, before, after: a row a candidate."""
    path = F.col(source_col).cast("string") if source_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), path.alias("path"), text_of(text_col).alias("text"))
    short = F.when(F.col("text").rlike("[=:]"), match_spans(F.col("text"), ASSIGNED)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))
    lead = lambda s: F.length(F.regexp_extract(s["value"], "^" + LEAD, 0))
    short = F.transform(short, lambda s: F.struct((s["start"] + lead(s)).alias("start"), s["end"].alias("end"), F.substr(s["value"], lead(s) + 1).alias("value")))
    long = match_spans(F.col("text"), RUN)
    # not again what is a run but for closing punctuation
    both = F.concat(long, F.filter(short, lambda s: ~F.exists(long, lambda r: (r["start"] == s["start"]) & F.substr(s["value"], F.length(r["value"]) + 1).rlike(r"^[,;.:)}\]>]*$"))))
    hit = F.transform(both, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
        F.substr(F.col("text"), F.greatest(F.lit(1), s["start"] - CONTEXT + 1), F.least(F.lit(CONTEXT), s["start"])).alias("before"),
        F.substr(F.col("text"), s["end"] + 1, F.lit(CONTEXT)).alias("after")))
    return rows.select("doc_id", "path", F.explode(hit).alias("f")).select("doc_id", "path", "f.*")


def _grams(word: Column) -> Column:
    """The three-letter sequences of a word of letters, in time linear in it."""
    return F.regexp_extract_all(word, F.lit(r"(?=(\p{L}{3}))"), F.lit(1))


def dictionary_of(docs: DataFrame, size: int, text_col: str = "text") -> DataFrame:
    """The ``size`` most frequent three-letter sequences of all words."""
    words = (docs.select(F.explode(F.regexp_extract_all(F.lower(text_of(text_col)), F.lit(r"\p{L}{3,}+"), F.lit(0))).alias("word"))
             .groupBy("word").agg(F.count("*").alias("n")))
    return (words.select("n", F.explode(_grams(F.col("word"))).alias("gram")).groupBy("gram").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "gram").limit(size).select("gram"))


def with_features(found: DataFrame, grams: DataFrame) -> DataFrame:
    v, n = F.col("value"), F.length("value").cast("double")
    near = F.lower(F.concat("before", F.lit(" "), "after"))
    keyed = found.withColumn("letters", F.lower(F.regexp_replace(v, r"[^\p{L}]", "")))
    # dictionary coverage of each different value
    parts = (keyed.select("letters").distinct().filter(F.length("letters") >= 3)
             .select("letters", F.explode(_grams(F.col("letters"))).alias("gram")))
    covered = (parts.join(F.broadcast(grams.withColumn("known", F.lit(1.0))), "gram", "left").groupBy("letters")
               .agg(F.avg(F.coalesce("known", F.lit(0.0))).alias("known")))
    # a table of its own: the join then has two plain exchanges, so AQE splits a frequent value (or none at all, as in numbers)
    return keyed.join(written(covered, "secret-coverage"), "letters", "left").drop("letters").withColumns({
        "length": n, "upper": _count(v, "[A-Z]") / n, "digit": _count(v, "[0-9]") / n, "other": _count(v, "[^A-Za-z0-9]") / n,
        "transitions": _count(v, "(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])") / n,
        "coverage": F.coalesce("known", F.lit(0.0)),
        "in_path": (F.col("before").rlike(r"[/\\.]$") | F.col("after").rlike(r"^[/\\]|^\.[a-z]{2,4}\b") | v.rlike("^/|/.*/") | F.coalesce(F.col("path").rlike(r"(?i)test|example|sample|[/\\]"), F.lit(False))).cast("double"),
        "named": F.col("before").rlike(rf"(?i)(?:{NAMES}){SUFFIX}[^\p{{L}}]{{0,6}}$").cast("double"),
        "assigned": F.col("before").rlike(r"[=:]\s{0,2}[\x22']?$").cast("double"),
        "quoted": (F.col("before").rlike(r"[\x22']$") & F.col("after").rlike(r"^[\x22']")).cast("double"),
        "documentation": near.rlike(r"example|commit|sha|hash|checksum|uuid|http").cast("double"),
    }).drop("known")


def label_findings(found: DataFrame) -> DataFrame:
    """Adds label: 1, 0 or null where no rule decides."""
    v = F.col("value")
    mixed = v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    return found.withColumn("label", F.when(v.rlike(PLACEHOLDER), 0).when(v.rlike(FORMATS), 1)
                            .when((F.col("named") == 1) & (F.col("assigned") == 1) & mixed, 1)
                            .when(v.rlike(r"^\p{L}+$|^[0-9 +/_-]+$|^[_+/-]+$"), 0))


def train_forest(labelled: DataFrame, max_train: int = 20_000, trees: int = 40, depth: int = 6, seed: int = 11):
    """A forest from rows with FEATURES and label; None without both labels."""
    # of findings with one value the one with the least features, so the forest is the same in every run
    one = (labelled.filter("label is not null").groupBy("value").agg(F.min(F.struct(*FEATURES, F.col("label").cast("double").alias("label"))).alias("f")))
    sample = written(one.orderBy(F.xxhash64("value"), "value").limit(max_train).select("f.*"), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8).fit(rows)
    # a fitted forest holds its training summary and with it the session, which can't go to the tasks once it has
    # observed a write; the forest that is read back has none
    path = scratch_path(labelled.sparkSession, "secret-forest")
    forest.write().save(path)
    return RandomForestClassificationModel.load(path)


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, dictionary: int = 2000, threshold: float = 0.5, **columns) -> DataFrame:
    """doc_id, start, end, value, score, kept for every finding; ``kept`` is
    false for those the forest takes for false positives. ``labelled``: the
    caller's labelled findings (FEATURES, value, label)."""
    grams = written(dictionary_of(docs, dictionary, columns.get("text_col", "text")), "secret-dictionary")
    found = written(with_features(findings(docs, **columns), grams), "secret-findings")
    forest = train_forest(label_findings(found) if labelled is None else labelled)
    if forest is None:
        return found.select("doc_id", "start", "end", "value", F.lit(0.5).alias("score"), F.lit(True).alias("kept"))
    scored = forest.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found))
    return (scored.withColumn("score", vector_to_array("probability")[1])
            .select("doc_id", "start", "end", "value", "score", (F.col("score") >= threshold).alias("kept")))


@register("op4_secret_scan")
def op4_secret_scan(spark, sf_dir):
    return scan_secrets(read_table(spark, sf_dir, "documents"))
