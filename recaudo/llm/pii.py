r"""Personal data: base patterns and information-theoretic sanitisation.

Base entities are e-mail addresses, IPv4 addresses, card numbers (12 to 19
digits that pass Luhn's test) and phone numbers (9 to 15 digits), each kind
leftmost and non-overlapping; a match that fails its test is dropped whole.
The patterns are the plain ones, written so that a very long run of matching
characters costs linear time: possessive repeats, and a match may begin only
at the start of such a run or where the last match ended (\G).

Sanitisation: the corpus tells how much a term reveals of an entity. With
lines as contexts, n(t, e) of the n(t) lines with the term hold the entity,
which has n(e) of all N lines; the term then discloses
PMI(t, e) / IC(e) = log(n(t, e) N / (n(t) n(e))) / log(N / n(e)) of the
entity's information, 1 if the entity is in every line with the term. Terms
that disclose at least ``threshold`` of an entity, in at least
``min_support`` different lines, are spans too, of kind ``term``, in every
document that says them, whether it holds the entity or not: that is where
they give it away. Counts cover all lines of all documents;
copies of a line count, but not as different ones. In
:func:`sanitised` base spans and terms that disclose at least ``remove`` are
cut to their kind's label; other terms are generalised to their first letter.

Only DataFrame functions. Counts are pre-aggregated before each shuffle, so a
very frequent word or entity is one row a task; the pairs of a line are its
few entities times its own words, never pairs of lines.

Null text counts as empty; a document without spans has zero counts, the
digest of the empty string and an empty list. Repeated rows get a row each;
terms are found by the text's digest, once for equal texts, so ids play no
part in it. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recaudo.operators.hot_keys import hot_left_join

from .common import read_table, text_of, written
from .registry import register
from .spans import match_spans

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"          # shorter ones fail the test anyway
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: A term: four letters or more.
TERM = r"\p{L}{4,}+"
KINDS = ("email", "ip", "card", "phone")
WITH_DIGITS = ("ip", "card", "phone")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total, i):
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """array<struct<start,kind,end,value>>, by start, then kind as listed."""
    def card(s):
        d = _digits(s["value"])
        return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)
    found = {
        "email": match_spans(text, EMAIL, "@"),
        "ip": F.filter(match_spans(text, IP, "."), lambda s: s["value"].rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$")),
        "card": F.filter(match_spans(text, CARD), card),
        "phone": F.filter(match_spans(text, PHONE, "+"), lambda s: F.length(_digits(s["value"])).between(9, 15)),
    }
    def placed(kind, spans):       # start, place of the kind, kind, end, value
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), F.lit(kind).alias("kind"),
                                                     s["end"].alias("end"), s["value"].alias("value")))
    ordered = F.array_sort(F.concat(*[placed(k, s) for k, s in found.items()]))
    return F.transform(ordered, lambda s: s.dropFields("place"))


def entity(kind: Column, value: Column) -> Column:
    """One name for an entity's spellings."""
    return F.concat(kind, F.lit(":"), F.when(kind == "email", F.lower(value)).when(kind == "ip", value).otherwise(_digits(value)))


def terms_of(line: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(line), F.lit(TERM), F.lit(0)))


def disclosing_terms(docs: DataFrame, marked: DataFrame, threshold: float, min_support: int) -> DataFrame:
    """entity, term, disclosure of the terms that give an entity away.
    ``docs``: text of all documents; ``marked``: of those with base spans."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    held = (marked.select(F.explode(F.split("text", "\n")).alias("line"))
            .withColumn("spans", base_spans(F.col("line"))).filter(F.size("spans") > 0)
            .withColumn("values", F.transform("spans", lambda s: s["value"]))
            .withColumn("entities", F.array_distinct(F.transform("spans", lambda s: entity(s["kind"], s["value"])))))
    held = written(held.groupBy("line", "values", "entities").agg(F.count("*").alias("lines")), "pii-lines")
    per_entity = held.select(F.explode("entities").alias("entity"), "lines").groupBy("entity").agg(
        F.sum("lines").alias("n_e"), F.count("*").alias("different"))
    often = per_entity.filter(F.col("different") >= min_support)
    # an entity's own letters are no terms
    rest = F.aggregate("values", F.col("line"), lambda left, v: F.replace(left, v, F.lit(" ")))
    pairs = (held.select(F.explode("entities").alias("entity"), rest.alias("rest"), "lines").join(often, "entity")
             .select("entity", "n_e", "lines", F.explode(terms_of(F.col("rest"))).alias("term"))
             .groupBy("entity", "term").agg(F.sum("lines").alias("n_te"), F.count("*").alias("different"), F.first("n_e").alias("n_e"))
             .filter(F.col("different") >= min_support))
    pairs = written(pairs, "pii-pairs")
    corpus = lines.select(F.explode(terms_of(F.col("line"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    n = lines.count()
    bits = lambda x: F.log(x.cast("double"))
    revealed = (bits(F.col("n_te")) + F.log(F.lit(float(max(n, 2)))) - bits(F.col("n_t")) - bits(F.col("n_e"))) / (F.log(F.lit(float(max(n, 2)))) - bits(F.col("n_e")))
    return (pairs.join(corpus, "term").withColumn("disclosure", F.when(F.col("n_e") < n, revealed).otherwise(0.0))
            .filter(F.col("disclosure") >= threshold).select("entity", "term", "disclosure"))


def find_pii(docs: DataFrame, threshold: float = 0.8, min_support: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, base (array of base spans) and terms (array of
    struct<start,end,value,disclosure>) for every row of ``docs``. The text is
    given for rows with spans only, so rows without any don't carry it along."""
    read = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("digest", F.md5(F.col("text").cast("binary")))
    found = written(read.withColumn("base", base_spans(F.col("text")))
                    .withColumn("text", F.when(F.size("base") > 0, F.col("text"))), "pii-base")
    marked = found.filter(F.size("base") > 0)
    telling = written(disclosing_terms(read.select("text"), marked, threshold, min_support)
                      .groupBy("term").agg(F.max("disclosure").alias("disclosure")), "pii-terms")
    # a text's telling terms; equal texts merge before they shuffle
    said = written(read.select("digest", F.explode(terms_of(F.col("text"))).alias("term")).join(telling, "term")
                   .groupBy("digest").agg(F.collect_set(F.struct("term", "disclosure")).alias("telling")), "pii-said")

    def place(s):
        at = F.array_position(F.col("telling.term"), F.lower(s["value"])).cast("int")
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.get(F.col("telling.disclosure"), at - 1).alias("disclosure"))
    terms = F.filter(F.transform(match_spans(F.col("text"), TERM), place), lambda s: s["disclosure"].isNotNull()
                     & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    none = F.array().cast("array<struct<start:int,end:int,value:string,disclosure:double>>")
    # copies of one text have one digest: frequent ones are dealt over salts. What has base spans is told apart
    # on the distinct digests, so that only rows with something to add are joined to their texts
    held = marked.select("digest").distinct().withColumn("held", F.lit(True))
    said = written(said.join(held, "digest", "left"), "pii-said-held")
    told = hot_left_join(marked, said.drop("held"), "digest", "doc_id")
    with_base = told.select("doc_id", "text", "base", F.when(F.col("telling").isNotNull(), terms).otherwise(none).alias("terms"))
    # texts without base spans: those with telling terms are read again, the others are not needed
    no_base = F.array().cast(found.schema["base"].dataType)
    new = said.filter(F.col("held").isNull()).drop("held")
    with_terms = (hot_left_join(read, new, "digest", "doc_id").filter(F.col("telling").isNotNull())
                  .withColumn("base", no_base).select("doc_id", "text", "base", terms.alias("terms")))
    clean = (hot_left_join(found.filter(F.size("base") == 0), new, "digest", "doc_id").filter(F.col("telling").isNull())
             .select("doc_id", "text", "base", none.alias("terms")))
    return with_base.unionByName(with_terms).unionByName(clean)


def sanitised(found: DataFrame, remove: float = 0.95) -> DataFrame:
    """doc_id and the text with its personal data cut or generalised, of the rows that have any."""
    cut = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("to")))
    told = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                       F.when(s["disclosure"] >= remove, F.lit("[TERM]")).otherwise(F.concat(F.substring(s["value"], 1, 1), F.lit("…"))).alias("to")))
    # from the last to the first, leaving out what overlaps a span that begins later
    step = lambda a, s: F.when(s["end"] > a["before"], a).otherwise(
        F.struct(F.overlay(a["text"], s["to"], s["start"] + 1, s["end"] - s["start"]).alias("text"), s["start"].alias("before")))
    clean = F.aggregate(F.reverse(F.array_sort(F.concat(cut, told))), F.struct(F.col("text").alias("text"), F.lit(2 ** 31 - 1).alias("before")), step, lambda a: a["text"])
    return found.filter((F.size("base") > 0) | (F.size("terms") > 0)).select("doc_id", clean.alias("text"))


def pii_digest(found: DataFrame) -> DataFrame:
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    every = F.concat(F.transform("base", lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).cast("int").alias("place"), s["kind"].alias("kind"), s["end"].alias("end"))),
                     F.transform("terms", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS) + 1).alias("place"), F.lit("term").alias("kind"), s["end"].alias("end"))))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS],
                        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.array_sort(every)).alias("spans"))


@register("op7_pii")
def op7_pii(spark, sf_dir):
    return pii_digest(find_pii(read_table(spark, sf_dir, "documents")))
