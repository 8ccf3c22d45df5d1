"""Secret scan with a random forest against false positives (operator 4).

DataFrame functions only.  Candidates are the runs of at least ``MIN_LENGTH``
key characters with a digit, or at a mail address or the password place of a
URL, as many as a word holds, and whatever of at least ``MIN_NAMED``
characters is assigned to a secret's name, digits or not.  An equals sign ends a
run (but for padding), and the context of a run is its own part of the word,
between commas, semicolons, ampersands and braces.  Features: length, share of
digits and of each letter case, transitions between character classes,
distinct characters, coverage by dictionary words, path signs, neighbouring
words.

The forest is trained on labelled findings: a table (value, is_secret) if
given, else ``labelled_findings`` - texts that hold findings of several forms,
secret or not by their form, whatever their context - with the corpus'
findings that their context labels: an assignment to a secret's name or the
password place of a URL marks a secret; e-mail, address, card and phone shapes
mark a false finding.  Each labelled finding of the corpus is learned from
twice, once with its neighbours hidden, so the forest judges bare values too.

``TRAINING_ROWS`` bounds the labelled rows the forest is fitted on (those
with the smallest hashes, of the corpus; ``LABELLED`` more are made); every document is scanned and scored.

Defined results: null, empty and blank texts have no findings; repeated rows
give repeated findings; without findings of both labels the context label
itself is the verdict; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lading.operators.materialize import Materializer
from lading.session import scratch_path

MIN_LENGTH, MIN_NAMED = 12, 6
BEFORE = 64                 # characters of the words before a word that are its context
TRAINING_ROWS = 20_000
LABELLED = 8_000
TREES, DEPTH, SEED = 24, 6, 4

# fixed values: names of secrets, names of harmless values, dictionary words
SECRET_NAMES = "(?i)(secret|token|passw|passwd|pwd|api[-_]?key|access[-_]?key|private[-_]?key|auth|bearer|credential)"
ORDINARY = ("authentication", "required", "documentation", "verification", "settings", "disabled", "default", "explained", "service",
            "response", "expired", "invalid", "storage", "session", "refresh", "manager")
PASSWORD_WORDS = ("hunter", "dragon", "summer", "monkey", "shadow", "winter", "orange", "silver", "falcon", "castle")
HARMLESS_NAMES = "(?i)(example|sample|dummy|placeholder|sha1|sha256|md5|checksum|commit|uuid|version|phone|tel|card|mail)"
DICTIONARY = ("(?i)(the|and|for|that|with|from|this|test|user|name|file|data|main|page|mail|example|index|image|com|www|"
              "http|html|die|der|und|das|les|des|que|para|con|ion|ing|ent)")
KEY_RUN = rf"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?"
PART_ENDS = "[,;&{}]+"
# a secret's name with an assignment sign, and with a value that ends in the word itself (after \x01)
ASSIGNING = SECRET_NAMES + r"[A-Za-z0-9_-]{0,32}[\"']?\s*[=:]"
ASSIGNED = ("(" + SECRET_NAMES + r"[A-Za-z0-9_-]{0,32}[\"']?[\s\x01]*(?:=>|[=:])[\s\x01]*[\"']*)"
            rf"([^\s\x01\"',;&{{}}<>()]{{{MIN_NAMED},}}+)(?![^\x01]*\x01)")
FEATURES = ("length", "digits", "upper", "lower", "hex", "transitions", "distinct", "dictionary", "path",
            "assigned", "named", "harmless")
CONTEXT = ("assigned", "named", "harmless")


def _share(value: Column, pattern: str) -> Column:
    return 1 - F.length(F.regexp_replace(value, pattern, "")) / F.length(value)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per candidate: id, word number, value, shape flags, features."""
    words = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
             .withColumn("naming", F.col("text").rlike(ASSIGNING))
             .where(F.col("text").rlike("[0-9]") | F.col("naming"))           # most texts end here
             .select("doc_id", "naming", F.split(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), " ").alias("w")))
    # neighbours are read for the few matching words only
    def before(i):
        return F.right(F.concat_ws(" ", F.get("w", i - 2), F.get("w", i - 1)), F.lit(BEFORE))

    near = F.transform("w", lambda x, i: F.when(
        (x.rlike("[0-9]") & x.rlike(KEY_RUN)) | (F.col("naming") & F.concat(before(i), F.lit(" \x01"), x).rlike(ASSIGNED)),
        F.struct(i.alias("word_no"), x.alias("word"), before(i).alias("before"))))
    found = words.select("doc_id", F.explode(F.filter(near, lambda s: s.isNotNull())).alias("c")).select("doc_id", "c.*")
    # the parts of a word, and of a part the texts around its runs (at odd places) and the runs
    found = found.select("*", F.posexplode(F.split(F.regexp_replace("word", f"^{PART_ENDS}", ""), PART_ENDS)).alias("part_no", "part"))
    found = found.withColumn("pieces", F.split(F.regexp_replace(F.translate("part", "\x01\x02", "??"), f"({KEY_RUN})", "\x01$1\x02"),
                                               "[\x01\x02]"))
    # values that a secret's name is given, in this part or the words before
    whole = F.concat(F.when(F.col("part_no") == 0, F.col("before")).otherwise(""), F.lit(" \x01"), F.translate("part", "\x01", "?"))
    given = F.arrays_zip(F.regexp_extract_all(whole, F.lit(ASSIGNED), 1).alias("name"), F.regexp_extract_all(whole, F.lit(ASSIGNED), 3).alias("own"))
    around = F.transform(F.filter(F.sequence(F.lit(1), F.size("pieces")), lambda i: i % 2 == 0), lambda i: F.struct(
        (i / 2).cast("int").alias("run_no"), F.element_at("pieces", i).alias("value"),
        # a run before may be the name of this one
        F.array_join(F.slice("pieces", F.greatest(i - 3, F.lit(1)), F.least(i - 1, F.lit(3))), "").alias("prefix"),
        F.element_at("pieces", i + 1).alias("rest"), F.lit(False).alias("given")))
    found = found.withColumns({"runs": around, "given": F.transform(given, lambda g: F.struct(
        F.lit(0).alias("run_no"), F.regexp_replace(g["own"], "[.:?]+$", "").alias("value"), F.translate(g["name"], "\x01", "").alias("prefix"),
        F.lit("").alias("rest"), F.lit(True).alias("given")))})
    # one candidate where a value that is given holds a run with a digit, or is one
    alone = F.filter("given", lambda g: (F.length(g["value"]) >= MIN_NAMED) & ~F.exists(
        F.col("runs"), lambda r: r["value"].rlike("[0-9]") & F.contains(g["value"], r["value"])))
    found = found.withColumn("run", F.explode(F.concat("runs", alone))).select("doc_id", "word_no", "before", "part_no", "part", "run.*")
    value = F.col("value")
    context = F.concat_ws(" ", F.when((F.col("part_no") == 0) & (F.col("run_no") <= 2), F.col("before")), "prefix")
    in_url = F.col("prefix").rlike("://[^/@]*:$") & F.col("rest").rlike("^@")
    mail = F.col("rest").rlike(r"^[A-Za-z0-9.%]*@[A-Za-z0-9-]*\.?") | F.col("prefix").rlike("@[A-Za-z0-9.-]*$")
    found = found.where(value.rlike("[0-9]") | mail | in_url | F.col("given"))
    around_run = F.concat(F.col("prefix"), value, F.col("rest"))
    changes = F.size(F.regexp_extract_all(value, F.lit("([a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9]))"), 1))
    return found.withColumns({
        "length": F.length(value).cast("double"),
        "digits": _share(value, "[0-9]"), "upper": _share(value, "[A-Z]"), "lower": _share(value, "[a-z]"),
        "hex": value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "transitions": changes / F.length(value),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "dictionary": _share(value, DICTIONARY),
        "path": around_run.rlike(r"(://|^/|[A-Za-z0-9]/[A-Za-z0-9].*/|\.[a-z]{2,4}\b)").cast("double"),
        "assigned": context.rlike(r"[=:]\s*[\\\"']*$").cast("double"),
        "named": (context.rlike(SECRET_NAMES) | in_url).cast("double"),
        "harmless": context.rlike(HARMLESS_NAMES).cast("double"),
        "other_shape": ((mail & ~in_url) | value.rlike(r"^\+?[0-9-]{11,23}$")
                        | F.col("part").rlike(r"^\W*\d{1,3}(\.\d{1,3}){3}\W*$")),
    })


def labelled_findings(spark: SparkSession, rows: int = LABELLED, seed: int = SEED) -> DataFrame:
    """Texts that hold one finding each (doc_id, text, is_secret): keys,
    passwords and tokens of several forms, and checksums, paths, identifiers,
    numbers and ordinary words in the places where such findings stand."""
    made = spark.range(rows).withColumn("r", F.sha2(F.concat_ws("/", F.lit(seed), "id"), 512))
    r, n = F.col("r"), F.conv(F.substring("r", 100, 7), 16, 10).cast("long")
    key = F.translate(F.base64(F.unhex(r)), "+/=\n\r", "xY")

    def word(choices, shift):
        return F.get(F.array(*map(F.lit, choices)), ((n / shift).cast("long") % len(choices)).cast("int"))

    letters = F.translate(F.lower(F.substring(key, 30, 24)), "0123456789", "qwertzuiop")
    password = F.concat(word(PASSWORD_WORDS, 1), (n % 1000).cast("string"), word(PASSWORD_WORDS, 10))
    forms = [
        (True, F.concat(F.lit('set api_key = "'), F.substring(key, 1, 32), F.lit('" here'))),
        (True, F.concat(F.lit("password: "), password)),
        (True, F.concat(F.lit("Authorization: Bearer "), F.substring(key, 1, 40))),
        (True, F.concat(F.lit("postgres://app:"), password, F.lit("77@db.example.com/main"))),
        (True, F.concat(F.lit("use AKIA"), F.upper(F.substring(key, 1, 16)), F.lit("9 for it"))),
        (True, F.concat(F.lit('"access_token":"'), F.substring(r, 1, 40), F.lit('"'))),
        (True, F.concat(F.lit('token = "'), letters, F.lit('"'))),
        (True, F.concat(F.lit("found "), F.substring(key, 1, 36), F.lit("3 in it"))),
        (False, F.concat(F.lit("commit "), F.substring(r, 1, 40))),
        (False, F.concat(F.lit("sha256: "), F.substring(r, 1, 64))),
        (False, F.concat(F.lit("in /usr/share/"), word(ORDINARY, 1), F.lit("/"), word(ORDINARY, 16), n.cast("string"), F.lit(".py"))),
        (False, F.concat(F.lit("call +49-30-"), (n + 1_000_000).cast("string"), F.lit("-22"))),
        (False, F.concat(F.lit("uuid: "), F.concat_ws("-", F.substring(r, 1, 8), F.substring(r, 9, 4), F.substring(r, 13, 4), F.substring(r, 17, 12)))),
        (False, F.concat(F.lit("token: "), word(ORDINARY, 1), F.when(n % 2 == 0, F.concat(F.lit("-"), word(ORDINARY, 16))).otherwise(""))),
        (False, F.concat(F.lit("call "), word(ORDINARY, 1), F.lit("_"), word(ORDINARY, 16), (n % 100).cast("string"))),
        (False, F.concat(word(ORDINARY, 1), F.lit("."), word(ORDINARY, 16), (n % 100).cast("string"), F.lit("@example.com"))),
    ]
    form = F.col("id") % len(forms)
    pick = reduce(lambda c, k: c.when(form == k, F.struct(forms[k][1].alias("text"), F.lit(forms[k][0]).alias("is_secret"))),
                  range(1, len(forms)), F.when(form == 0, F.struct(forms[0][1].alias("text"), F.lit(forms[0][0]).alias("is_secret"))))
    return made.select(F.col("id").alias("doc_id"), pick.alias("f")).select("doc_id", "f.*")


def scan(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         training_rows: int = TRAINING_ROWS) -> DataFrame:
    """One row per candidate: id, word number, masked value, length, the
    forest's ``score`` and the verdict ``is_secret``."""
    spark = docs.sparkSession
    keep = Materializer(spark, scratch_path(spark, f"secrets-{uuid.uuid4().hex[:12]}"))
    found = keep("candidates", candidates(docs, id_col, text_col))     # texts are read once; the forest reads these rows
    by_context = (F.when(F.col("other_shape"), 0.0)
                  .when((F.col("assigned") == 1) & (F.col("named") == 1) & (F.col("harmless") == 0), 1.0)
                  .when(F.col("harmless") == 1, 0.0))
    if findings is None:
        labelled = found.withColumn("label", by_context)
    else:
        labelled = found.join(findings.select("value", F.col("is_secret").cast("double").alias("label")), "value")
    labelled = keep("labelled", labelled.where("label is not null").select("value", "label", *FEATURES).distinct()
                    .orderBy(F.xxhash64("value", *FEATURES)).limit(training_rows))
    hidden = labelled.withColumns({c: F.lit(0.0) for c in CONTEXT})
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    rows = labelled.unionByName(hidden)
    if findings is None:
        made = labelled_findings(spark)
        made = candidates(made).join(made.select("doc_id", F.col("is_secret").cast("double").alias("label")), "doc_id")
        rows = rows.unionByName(made.select(*rows.columns))
    rows = keep("training", assembler.transform(rows).select("label", "features"))
    masked = F.concat(F.substring("value", 1, 4), F.lit("…"))
    if rows.select("label").distinct().count() < 2:
        scored = found.withColumn("score", F.coalesce(by_context, F.lit(0.5)))
    else:
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label").fit(rows)
        scored = (forest.transform(assembler.transform(found))
                  .withColumn("score", vector_to_array("probability")[1]))
    return scored.select("doc_id", F.col("word_no").cast("long").alias("word_no"), masked.alias("masked"),
                         F.col("length").cast("int").alias("length"), "score", (F.col("score") >= 0.5).alias("is_secret"))
