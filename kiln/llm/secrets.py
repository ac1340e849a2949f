"""Secret scans with a random forest against false positives.

Candidates are runs of token characters: those of 12 and more that hold a digit
wherever they stand, all others (letters only, or short) where a secret's name
or an assignment stands beside them. A quoted phrase assigned to a secret's name
is one run with its blanks. Each gets features from built-in SQL functions: its
length, how its characters alternate between classes, how much of it dictionary
words cover, its path and the words beside it. A random forest (Spark ML)
trained from labelled findings decides.

DataFrame and ML operators only: no Python code runs on the executors. Texts
without a candidate leave after one regular expression; only the others are cut
into words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import BLANKS, keep
from kiln.session import reloaded

#: Characters of a run besides letters and digits; ``GLUE`` stands for a blank in a quoted phrase.
GLUE = "\x01"
MARKS = r"_+/.$!@#~%^&*?\x01-"
#: A run: dots and question marks at its end belong to the sentence unless a quote follows, = only pads.
CANDIDATE = rf"[A-Za-z0-9{MARKS}]*(?:[A-Za-z0-9_+/$!@#~%^&*-]|[.?](?=[\"'`]))(?:={{1,2}}(?![A-Za-z0-9={MARKS}]))?"
LONG = 12
#: A text or word that holds a run of 12 characters with a digit.
HOLDS = rf"(?=[A-Za-z0-9={MARKS}]{{{LONG}}})[A-Za-z={MARKS}]*[0-9]"
TRAINING = 20_000  # findings the forest is fitted on, at most about
DICTIONARY = 500
TREES, DEPTH = 20, 6

NAMES = r"(?i)(secret|token|passw|pwd|api_?key|apikey|auth|bearer|credential|private|access_?key)"
ASSIGNED = r"[=:][\"'`(\[{ ]*$"
#: A quote that opens where a secret's name is assigned; cheap beside the next one.
OPENS = rf"{NAMES}[^ \"'`]{{0,40}} ?[=:] ?[\"'`]"
#: A blank inside quotes that open where a secret's name is assigned (at most 200 characters).
IN_PHRASE = rf"(?<={NAMES.replace('(?i)(', '(?i:')}[^ \"'`]{{0,40}} ?[=:] ?[\"'`][^\"'`]{{0,200}}) (?=[^\"'`]{{0,200}}[\"'`])"
HARMLESS = r"(?i)(sha\d*|md5|commit|checksum|digest|hash|uuid|phone|tel|card|example|sample|dummy|test)"

FEATURES = [
    "length", "transitions", "distinct", "digits", "uppers", "hex_only", "digits_only", "punctuation", "covered",
    "path_depth", "path_test", "path_config", "named", "harmless", "assigned", "quoted", "prev_length", "next_length",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: Column | None = None) -> DataFrame:
    """``(id, word, nth, value, token, lead, before, prev, next, path)`` of every candidate in whole texts.

    ``word``: the number of the word in its text; ``nth``: of the run in its
    word; ``token``: the word as written, ``lead``: its part before the run;
    ``before`` and ``prev`` / ``next``: its neighbours (empty at the ends).
    """
    path = F.lit("") if path is None else F.coalesce(path.cast("string"), F.lit(""))
    text = F.trim(F.regexp_replace("text", BLANKS, " "))
    words = F.split(F.when(F.col("phrased"), F.regexp_replace("text", IN_PHRASE, GLUE)).otherwise(F.col("text")), " ", -1)
    w = lambda at: F.coalesce(F.get("words", at), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), path.alias("path"))
    d = d.where(F.col("text").rlike(HOLDS) | F.col("text").rlike("[=:]") | F.col("text").rlike(NAMES)).select("id", "path", text.alias("text"))
    d = d.withColumn("phrased", F.col("text").rlike(OPENS)).select("id", "path", "phrased", words.alias("words"))
    # 2: the word holds a long run; 1: it can be what stands beside another one
    hints = F.transform("words", lambda x: F.when(x.rlike(HOLDS), 2).otherwise(0) + F.when(x.rlike("[=:]") | x.rlike(NAMES), 1).otherwise(0))
    beside = lambda at: F.coalesce(F.get("hints", at), F.lit(0)) % 2 == 1
    d = d.withColumn("hints", hints).withColumn(
        "at", F.explode(F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: (F.get("hints", i) > 0) | beside(i - 1) | beside(i - 2)))
    )
    glued = F.when(F.col("phrased"), F.regexp_count(F.array_join(F.slice("words", 1, F.col("at")), " "), F.lit(GLUE)))
    found = d.select(
        "id", "path", (F.col("at") + F.coalesce(glued, F.lit(0))).alias("word"), w(F.col("at")).alias("token"), w(F.col("at") - 2).alias("before"),
        w(F.col("at") - 1).alias("prev"), w(F.col("at") + 1).alias("next"),
    ).withColumn("runs", F.regexp_extract_all("token", F.lit(CANDIDATE), 0))
    found = found.select("*", F.posexplode("runs").alias("nth", "value"))
    # what stands before the nth run: the runs before it and the gaps up to it
    at = F.aggregate(F.slice("runs", 1, F.col("nth")), F.lit(0), lambda n, x: n + F.length(x)) + F.aggregate(
        F.slice(F.split("token", CANDIDATE, -1), 1, F.col("nth") + 1), F.lit(0), lambda n, x: n + F.length(x)
    )
    found = found.withColumn("lead", F.substring("token", F.lit(1), at)).drop("runs")
    long = (F.length("value") >= LONG) & F.col("value").rlike("[0-9]")
    assigned = F.concat_ws(" ", "prev", "lead").rlike(ASSIGNED) & ~(F.col("lead").endswith(":") & F.col("value").startswith("//"))
    # marks alone, as after a closing quote, only where they are assigned
    named = F.concat_ws(" ", "before", "prev", "lead").rlike(NAMES) & F.col("value").rlike("[A-Za-z0-9]")
    found = found.where(long | assigned | named)
    return found.withColumn("value", F.translate("value", GLUE, " "))


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.length("value")


def with_features(found: DataFrame, dictionary: Sequence[str]) -> DataFrame:
    """``found`` with a double column per feature; ``dictionary`` words are lower-case letters."""
    classes = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9"), "_+/=.$!@#~%^&*? -", "-" * 17)
    left = F.lower("value")
    if dictionary:
        left = F.regexp_replace(left, "|".join(sorted(dictionary, key=lambda w: (-len(w), w))), "")
    lead = F.col("lead")
    beside = F.concat_ws(" ", "before", "prev", lead)
    n = F.length("value")
    exprs = {
        "length": n,
        "transitions": (F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / F.greatest(n - 1, F.lit(1)),
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / n,
        "digits": _share("[0-9]"),
        "uppers": _share("[A-Z]"),
        "hex_only": F.col("value").rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "digits_only": F.col("value").rlike("^[0-9-]+$"),
        "punctuation": _share("[^A-Za-z0-9]"),
        "covered": (n - F.length(left)) / n,
        "path_depth": F.regexp_count("path", F.lit("/")),
        "path_test": F.col("path").rlike("(?i)(test|example|sample|doc|fixture)"),
        "path_config": F.col("path").rlike(r"(?i)(conf|\.env|settings|\.ya?ml|\.ini|\.properties)"),
        "named": beside.rlike(NAMES),
        "harmless": beside.rlike(HARMLESS),
        "assigned": F.concat_ws(" ", "prev", lead).rlike("[=:]"),
        "quoted": lead.rlike("[\"'`]$"),
        "prev_length": F.length("prev"),
        "next_length": F.length("next"),
    }
    return found.select("*", *[exprs[f].cast("double").alias(f) for f in FEATURES])


def neighbour_dictionary(found: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The ``size`` most frequent lower-case words of 3 letters and more beside candidates."""
    words = found.select(F.explode(F.array("before", "prev", "next")).alias("w")).select(F.lower("w").alias("w"))
    top = words.where(F.col("w").rlike("^[a-z]{3,}$")).groupBy("w").agg(F.count("*").alias("n"))
    return [r["w"] for r in top.orderBy(F.desc("n"), "w").limit(size).collect()]


def weak_labels(rows: DataFrame) -> DataFrame:
    """``(value, label)`` of the findings ``rows`` (with features) that a plain reading decides.

    Stands in for reviewed findings where there are none: a value of 20 mixed
    characters that a secret's name is assigned beside is a secret, and so is one of
    8 and more without a digit, or with one but under 12, unless words of the dictionary make up
    half of it; digits only, or a value that a harmless name stands beside, is
    not, nor is a value of letters without a secret's name beside it, or made up of words.
    A value read both ways is left out.
    """
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]") & (F.length("value") >= 20)
    names = F.concat_ws(" ", "before", "prev", "token")
    letters = ~F.col("value").rlike("[0-9]")
    phrase = F.col("value").contains(" ")
    weak = (F.length("value") >= 8) & (letters | (F.length("value") < LONG)) & ((F.col("covered") < 0.5) | phrase)
    named = F.col("named") == 1
    label = (
        F.when(F.col("value").rlike("^[0-9-]+$") | names.rlike(HARMLESS), 0)
        .when(mixed & names.rlike(NAMES) & F.concat_ws(" ", "prev", "token").rlike("[=:]"), 1)
        .when(weak & named & F.concat_ws(" ", "prev", "lead").rlike(ASSIGNED), 1)
        .when(letters & ~phrase & (~named | (F.col("covered") >= 1)), 0)
    )
    read = rows.select("value", label.alias("label")).where("label IS NOT NULL").groupBy("value")
    return read.agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")


def scan(
    docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
    path: Column | None = None, threshold: float = 0.5, seed: int = 5,
) -> DataFrame:
    """One row per candidate: ``id, word, nth, value_sha256, length, p_secret, is_secret``.

    ``labels``: labelled findings ``(value, label 0/1)``; weak labels of the same
    findings by default. The forest is fitted on a hash-drawn sample of about
    ``TRAINING`` of them.
    * null and empty texts have no candidate; null paths count as empty;
    * repeated rows give repeated findings; an empty table gives no rows;
    * if the labels hold one class only (or none), that class (0 if none) is the
      answer for every finding.
    """
    found = keep(candidates(docs, id_col, text_col, path), "candidates")
    rows = with_features(found, neighbour_dictionary(found))
    known = (weak_labels(rows) if labels is None else labels).where("value IS NOT NULL AND label IS NOT NULL")
    known = known.groupBy("value").agg(F.max(F.col("label").cast("double")).alias("label"))
    # a value's findings differ in path and neighbours: one of each is enough to learn from
    training = rows.join(known, "value").dropDuplicates([*FEATURES, "label"])
    training = keep(training.select("value", *FEATURES, "label"), "training")
    total, positive = training.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).collect()[0]
    out = [F.col("id").alias(id_col), "word", "nth", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("length")]
    if not 0 < positive < total:
        p = F.lit(float(total > 0 and positive == total))
        return rows.select(*out, p.alias("p_secret"), (p >= threshold).alias("is_secret"))
    drawn = F.pmod(F.xxhash64(F.lit(seed), *FEATURES), F.lit(1 << 20)) < int((1 << 20) * min(1.0, TRAINING / total) + 1)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featuresCol="features", labelCol="label")
    model = reloaded(docs.sparkSession, forest.fit(assembler.transform(training.where(drawn))))
    scored = model.transform(assembler.transform(rows)).withColumn("p_secret", F.round(vector_to_array("probability")[1], 9))
    return scored.select(*out, "p_secret", (F.col("p_secret") >= threshold).alias("is_secret"))
