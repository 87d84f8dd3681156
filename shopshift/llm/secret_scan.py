"""Secret scan with a random forest that removes false positives.  DataFrame functions only.

Strings that look like keys are extracted with their places and described by
their length, their character transitions, the share of them that dictionary
words cover, the document's path and the words around them.  A random forest
trained on labelled findings decides which are secrets: those given, or the
kinds of :mod:`shopshift.llm.labelled_findings`, hard negatives among them.
"""

from __future__ import annotations

from dataclasses import asdict
from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopshift.llm import labelled_findings as LF
from shopshift.llm.common import fresh_name, stage

#: Words before an assignment that announce a secret, and parts of paths and words that announce a sample.
KEYWORDS = "password|passwd|pwd|passphrase|secret|token|credential|auth|apikey|api[_-]?key|access[_-]?key|private[_-]?key|key"
_ASSIGN = r"[ \t]{0,16}(?::=|=>|[=:])[ \t]{0,16}"
_BEHIND = rf"(?<=(?i:{KEYWORDS})['\"]?{_ASSIGN}"
_KEY = r"(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{12,}+"
#: What ends a value without quotes: the next assignment, or punctuation before white space, a quote or the end.
_STOP = r"[&;,][A-Za-z_][\w.-]{0,40}=|[&;,.)\]}>]{1,8}(?:[\s'\"]|\z)"
#: What is looked at: a published format, joined tokens, the password of an URL, a value behind a keyword of any
#: form and length, 12 or more key characters with a digit among them, or a value that is assigned.
CANDIDATE = (
    r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
    # (groups are possessive: the matcher goes back into none, however many parts a token has)
    # tokens joined by dots: a JWT, or parts of 16 or more whose first has a digit
    r"|(?<![A-Za-z0-9_+/.-])(?:eyJ[A-Za-z0-9_-]{4,}+(?:\.{1,2}[A-Za-z0-9_-]{4,}+)++|(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+(?:\.[A-Za-z0-9_-]{16,}+)++)"
    # user:password@ of an URL
    r"|(?<=:)(?<=://[^\s/:@'\"]{0,64}:)[^\s/'\"<>]+(?=@)"
    # behind a keyword: what is quoted, unless white space and a candidate are in it, and a value up to white space or _STOP
    rf"|(?<=[=:> \t]['\"])(?:{_BEHIND}\")(?:(?:[^\s\"\\]|\\.)++(?=\")|(?![^\"\r\n]*(?:[=:]|{_KEY}))(?:[^\"\\\r\n]|\\.)++(?=\"))"
    rf"|{_BEHIND}')(?:(?:[^\s'\\]|\\.)++(?=')|(?![^'\r\n]*(?:[=:]|{_KEY}))(?:[^'\\\r\n]|\\.)++(?=')))"
    rf"|(?<=[=:>'\"]|[=:>'\" \t][ \t]){_BEHIND}['\"]?)(?![=:>])(?!{_STOP})(?:(?!{_STOP})[^\s'\"])++"
    rf"|(?<![A-Za-z0-9_+/-]){_KEY}={{0,2}}"
    r"|(?<=[=:]['\"]|[=:] ['\"])[^\s'\"]{8,}+"
    r"|(?<==)(?=[^\s'\"&;,<>]*+[0-9])[^\s'\"&;,<>()#*$%]{8,}+"
)
#: Words near a value that is no secret whatever its form.
DIGESTS = r"(?<![a-z])(commit|revision|checkout|merged|tree|sha[0-9]*|md5|checksum|digest|etag|hash|uuid|guid|build|version|tag|image|base64|device|request)(?![a-z])"
#: A word that announces a sample, by itself and not in a domain.
SAMPLE_WORD = r"(?<![a-z.@])(test|example|sample|mock|dummy|fixture)s?(?![a-z]|\.[a-z])"
SAMPLES = "test|example|sample|mock|dummy|fixture|docs?/"
#: What stands before the password of an URL.
URL_USER = "://[^\\s/:@'\"]*:$"
#: What stands for a value: a variable, a place to be filled, a call, an attribute, a word of programs.
REFERENCE = r"^([$][{(].*|[$][A-Z_]+|[A-Z]+(_[A-Z]+)+|%.*%|[{<\[(].*|[A-Za-z_][A-Za-z0-9_.]*[(\[].*|[A-Za-z_]+([.][A-Za-z_]+)+|(?i:null|none|nil|true|false|undefined))$"
#: Formats that providers publish.
KNOWN_FORMATS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{10,}.*)$"

#: A dictionary word: letters, as long as this, in so many different texts and in this share of them at least.
WORD_LETTERS, WORD_COUNT, WORD_SHARE = 4, 5, 1e-5
#: Labelled findings of each class that the forest is trained on.
TRAIN_FINDINGS = 2000
TREES, DEPTH, SEED = 60, 10, 7
AROUND = 40
FEATURES = [
    "f_length", "f_digits", "f_upper", "f_lower", "f_other", "f_hex", "f_distinct", "f_digit_letter", "f_letter_digit", "f_lower_upper",
    "f_upper_lower", "f_vowel_consonant", "f_repeat", "f_words", "f_sample_path", "f_keyword", "f_assigned", "f_quoted", "f_sample_word",
    "f_digest_word", "f_reference", "f_format",
]
REDACTED = "[SECRET]"


def _share(pattern: str, of: Column) -> Column:
    return F.regexp_count(of, F.lit(pattern)) / F.length(of)


#: Marks around candidates: code points that Unicode reserves and no text has; one that is there all the same is read as U+FFFD.
_OPEN, _CLOSE = "\ufdd0", "\ufdd1"


def candidates(docs: DataFrame, path_col: str | None = None) -> DataFrame:
    """row_key, doc_id, path, start (code points from 0), candidate, before and after, of documents (doc_id, text).

    One pass of the expression marks the candidates; the text is cut at the
    marks into gaps and candidates in turn, of which only lengths and ends go on.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    marked = F.regexp_replace(F.translate("text", _OPEN + _CLOSE, "\ufffd\ufffd"), CANDIDATE, f"{_OPEN}$0{_CLOSE}")
    parts = F.transform(
        F.split(marked, f"[{_OPEN}{_CLOSE}]"),
        lambda p, i: F.struct(
            F.length(p).alias("length"), F.left(p, F.lit(AROUND)).alias("head"), F.right(p, F.lit(AROUND)).alias("tail"),
            F.when(i % 2 == 1, p).alias("candidate"),
        ),
    )
    # the row's number comes before the parts
    numbered = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), "doc_id", path.alias("path"), parts.alias("parts"), F.monotonically_increasing_id().alias("row"))
    each = numbered.select("row_key", "doc_id", "path", "row", F.posexplode("parts").alias("i", "part"))
    # a row of a text has its parts in one place; sums run over them once
    order = Window.partitionBy("row").orderBy("i")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = each.select(
        "row_key", "doc_id", "path", "part.candidate",
        F.coalesce(F.sum(F.col("part.length").cast("long")).over(earlier), F.lit(0).cast("long")).alias("start"),
        F.concat(F.coalesce(F.lag("part.tail", 2).over(order), F.lit("")), F.coalesce(F.lag("part.tail", 1).over(order), F.lit(""))).alias("before"),
        F.coalesce(F.lead("part.head", 1).over(order), F.lit("")).alias("after"),
    )
    return placed.filter("candidate is not null").select("row_key", "doc_id", "path", "start", "candidate", F.right("before", F.lit(AROUND)).alias("before"), "after")


def dictionary(docs: DataFrame) -> DataFrame:
    """Words of ``WORD_LETTERS`` or more ASCII letters that stand outside candidates in enough different texts.

    Enough is ``WORD_COUNT`` and the share ``WORD_SHARE`` of all different texts.  Equal texts are one, so copies
    of a text add nothing, and no candidate vouches for itself.
    """
    prose = F.regexp_replace("text", F.lit(CANDIDATE), F.lit(" "))
    own = F.array_distinct(F.regexp_extract_all(F.lower(prose), F.lit("[a-z]{%d,}" % WORD_LETTERS), 0))
    texts = docs.filter(F.col("text").isNotNull()).select(F.xxhash64("text").alias("h"), "text")
    least = texts.select("h").distinct().agg(F.greatest(F.lit(WORD_COUNT), F.ceil(F.count("*") * F.lit(WORD_SHARE))).alias("least"))
    # each word of a text once, dealt by both, so that a word in every text is in many tasks
    counted = texts.select("h", F.explode(own).alias("word")).distinct().groupBy("word").agg(F.count("*").alias("n"))
    return counted.crossJoin(F.broadcast(least)).filter(F.col("n") >= F.col("least")).select("word")


def with_common_words(known: DataFrame) -> DataFrame:
    """The dictionary and the words of names and samples that any corpus may have."""
    words = [w for w in LF.WORDS if len(w) >= WORD_LETTERS]
    # from Arrow: rows of Python objects would start a daemon and workers on every executor
    return known.unionAll(known.sparkSession.createDataFrame(pa.table({"word": pa.array(words, pa.string())}), "word string")).distinct()


def described(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with the columns ``FEATURES``; ``known`` is the dictionary."""
    c = F.col("candidate")
    runs = F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{%d,}" % WORD_LETTERS), 0))
    covered = (
        found.select("candidate", F.explode(runs).alias("word")).distinct()
        .join(known, "word")
        .groupBy("candidate").agg(F.sum(F.length("word")).alias("covered"))
    )
    before = F.lower("before")
    return (
        found.join(covered, "candidate", "left")
        .withColumn("f_length", F.length(c).cast("double"))
        .withColumn("f_digits", _share("[0-9]", c))
        .withColumn("f_upper", _share("[A-Z]", c))
        .withColumn("f_lower", _share("[a-z]", c))
        .withColumn("f_other", _share("[^A-Za-z0-9]", c))
        .withColumn("f_hex", _share("[0-9a-fA-F]", c))
        .withColumn("f_distinct", F.size(F.array_distinct(F.split(c, ""))) / F.length(c))
        .withColumn("f_digit_letter", _share("[0-9](?=[A-Za-z])", c))
        .withColumn("f_letter_digit", _share("[A-Za-z](?=[0-9])", c))
        .withColumn("f_lower_upper", _share("[a-z](?=[A-Z])", c))
        .withColumn("f_upper_lower", _share("[A-Z](?=[a-z])", c))
        .withColumn("f_vowel_consonant", _share("(?i)[aeiou](?=[b-df-hj-np-tv-z])", c))
        .withColumn("f_repeat", _share(r"(.)(?=\1)", c))
        .withColumn("f_words", F.least(F.coalesce(F.col("covered"), F.lit(0)) / F.length(c), F.lit(1.0)))
        .withColumn("f_sample_path", F.lower("path").rlike(SAMPLES).cast("double"))
        .withColumn("f_keyword", before.rlike(f"({KEYWORDS})['\"]?\\s*(:=|=>|=|:|is)?\\s*['\"]?$|{URL_USER}").cast("double"))
        .withColumn("f_assigned", before.rlike("([=:]|=>)\\s*['\"]?$").cast("double"))
        .withColumn("f_quoted", before.rlike("['\"]$").cast("double"))
        .withColumn("f_sample_word", (before.rlike(SAMPLE_WORD) | F.lower("after").rlike(SAMPLE_WORD) | F.lower(c).rlike("example|sample|changeme|xxxx")).cast("double"))
        .withColumn("f_digest_word", before.rlike(DIGESTS).cast("double"))
        .withColumn("f_reference", c.rlike(REFERENCE).cast("double"))
        .withColumn("f_format", c.rlike(KNOWN_FORMATS).cast("double"))
        .drop("covered")
    )


def default_findings(spark: SparkSession, held_out: bool | None = False) -> DataFrame:
    """The labelled findings of the package (a bounded number); only those held out, or not, or all (None)."""
    rows = [asdict(f) for f in LF.findings() if held_out is None or LF.held_out(f) == held_out]
    names = ["candidate", "before", "after", "path", "label", "kind"]
    cols = [pa.array([r[n] for r in rows], pa.int32() if n == "label" else pa.string()) for n in names]
    return spark.createDataFrame(pa.table(cols, names=names), "candidate string, before string, after string, path string, label int, kind string")


def train(findings: DataFrame):
    """A forest on ``findings`` (``FEATURES`` and label 0 or 1); None unless there are both classes.

    At most ``TRAIN_FINDINGS`` different findings of each class are taken, by a hash of the candidate and what is before it.
    """
    what = ["candidate", "before"]
    own = findings.filter("label in (0, 1)").groupBy(*what, "label").agg(*[F.min(f).alias(f) for f in FEATURES]).withColumn("h", F.xxhash64(*what))
    parts = [own.filter(F.col("label") == y).orderBy("h", *what).limit(TRAIN_FINDINGS) for y in (0, 1)]
    rows = stage(reduce(DataFrame.unionByName, parts).coalesce(1).select(F.col("label").cast("double").alias("label"), *FEATURES), "labelled_findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))


def scan(docs: DataFrame, path_col: str | None = None, labelled: DataFrame | None = None) -> DataFrame:
    """Secrets in documents (doc_id, text): row_key, doc_id, start, length, secret and score (above 0.5).

    ``labelled`` has candidate, before, after, path and label (0, 1); without
    it those of :func:`default_findings` train the forest.  If they hold one
    class only, that class is every finding's.
    Null and empty texts hold no secrets; a null doc_id stays null; repeated
    rows are found each.  ``row_key`` is xxhash64 of doc_id and text.
    """
    known = stage(with_common_words(dictionary(docs)), "dictionary")
    raw = stage(candidates(docs, path_col), "raw_candidates")  # read twice to be described
    found = stage(described(raw, known), "candidates")
    if labelled is None:
        labelled = default_findings(docs.sparkSession)
    own = described(labelled.select("candidate", "before", "after", "path", "label"), known)
    model = train(own)
    if model is None:
        only = own.agg(F.coalesce(F.max("label"), F.lit(0))).first()[0]
        scored = found.withColumn("score", F.lit(float(only)))
    else:
        said = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
        scored = said.withColumn("score", vector_to_array("probability")[1])
    return scored.filter("score > 0.5").select("row_key", "doc_id", "start", F.length("candidate").cast("long").alias("length"), F.col("candidate").alias("secret"), "score")


def redact(docs: DataFrame, secrets: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by ``REDACTED`` in the text (and n_chars, if there, made to fit).

    Rows without a candidate pass as they are; only the others meet the findings.
    """
    key, spans = fresh_name(docs, "row_key"), fresh_name(docs, "spans")
    suspect = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    # the findings of one text
    found = secrets.groupBy(F.col("row_key").alias(key)).agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias(spans))
    s, text = F.col(spans), F.col("text")
    pieces = F.transform(
        s,
        lambda x, i: F.concat(
            text.substr(F.when(i > 0, s[i - 1]["end"]).otherwise(0).cast("int") + 1, (x["start"] - F.when(i > 0, s[i - 1]["end"]).otherwise(0)).cast("int")),
            F.lit(REDACTED),
        ),
    )
    tail = text.substr(s[F.size(s) - 1]["end"].cast("int") + 1, F.length(text))
    joined = docs.filter(suspect).withColumn(key, F.xxhash64("doc_id", "text")).join(found, key, "left")
    cleaned = joined.withColumn("text", F.when(s.isNotNull(), F.concat(F.array_join(pieces, ""), tail)).otherwise(text))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(s.isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return docs.filter(~suspect).unionByName(cleaned.select(*docs.columns))
