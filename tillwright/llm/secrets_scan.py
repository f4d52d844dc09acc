"""Secret scans with a random forest that removes false positives (operator 8).

One regular expression proposes candidates: long runs of key characters with a digit, whatever is assigned
to a secret's name or quoted after it, and passwords in URLs. A random forest
on length, character transitions, dictionary coverage, path and neighbouring words, fitted on labelled
findings, scores them. Everything runs as DataFrame expressions and Spark's own forest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import stored, text_or_empty

KEY_RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+={0,2}"
CONTEXT = 40
TREES, DEPTH, SEED = 24, 6, 5
# The forest is fitted on at most so many labelled findings, those with the smallest hashes.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.5

# Words that make up ordinary identifiers, and words that stand near secrets or near what is none.
DICTIONARY = (
    "able access address author base build cache card change class client code color commit config content count data date "
    "default document error event example field file final first format function group handler hash header html http image "
    "index input item kind label length level license line list local log main message method model module name network "
    "node number object option order output page param parent part path pattern place policy point port position process "
    "project property public query random range read record request response result root sample schema script search section "
    "select server service session simple size source start state status string style system table task template test text "
    "thread time title type unit update user value version video view window word work write"
).split()
SECRET_WORDS = r"(?i)(?<![a-z])(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|auth(?:orization)?|bearer|credential|key)s?(?![a-z])"
PLAIN_WORDS = r"(?i)(?<![a-z])(?:example|sample|dummy|placeholder|commit|sha1|sha256|md5|checksum|digest|uuid|guid|hash|isbn|serial|card|visa|version|license)(?![a-z])"
# A value of 6 characters or more after a secret's name: to the closing quote, or to the next space.
_NAMED = SECRET_WORDS.replace("(?i)", "", 1)
_AFTER_NAME = rf"(?<=[=:\"'` \t])(?<=[=:\"'`]|[=:][ \t]{{1,3}}|(?i:bearer)[ \t]{{1,3}})(?<=(?i:{_NAMED})[0-9_]{{0,3}}[\"'`\])]?[ \t]{{0,3}}[=:]?[=:>]?[ \t]{{0,3}}[\"'`]?)"
_UNQUOTED = r"(?!(?i:bearer|basic)[ \t])[^\s\"'`,;<>]{5,}[^\s\"'`,;<>.)\]}]"
NAMED_VALUE = _AFTER_NAME + rf"(?:(?<=\")[^\"\r\n]{{6,200}}(?=\")|(?<=')[^'\r\n]{{6,200}}(?=')|(?<=`)[^`\r\n]{{6,200}}(?=`)|{_UNQUOTED})"
URL_PASSWORD = r"(?<=:)(?<=://[^\s/:@\"']{1,64}:)[^\s/@\"']{6,}(?=@)"
# Every secret's name, and every URL, holds one of these; other texts need the key runs only.
NAME_PARTS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "://")
CANDIDATE = rf"(?:{URL_PASSWORD}|{NAMED_VALUE}|{KEY_RUN})"
# Values that stand where a secret would: variables, masks, placeholders.
NO_VALUE = r"(?i)\A(?:[<$%{*(\[].*|x+|\.+|none|null|true|false|undefined|required|optional|unknown)\z"
# Formats that providers publish; a finding in one of them is labelled as a secret.
KNOWN_FORMATS = (
    r"\A(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[0-9A-Za-z-]{10,}|sk_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35})\z"
)
PATH_WORDS = r"(?i)(?:config|env|secret|settings|deploy|credentials|\.pem|\.key|\.ya?ml|\.ini)"

FEATURES = (
    "length", "digit_share", "upper_share", "lower_share", "transitions", "distinct_share", "hexadecimal",
    "covered", "assigned", "quoted", "secret_word", "plain_word", "sentence_around", "path_word",
)


def _share(text: Column, characters: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{characters}]", "")) / F.greatest(F.length(text), F.lit(1))


def candidates(docs: DataFrame, path_column: str = "source") -> DataFrame:
    """doc_id, path, candidate, start, end (code points, end exclusive), before, after; a row per candidate.

    Quoted values are taken up to 200 characters with their spaces, others to the next space or delimiter.
    Texts are scanned whole. Null and empty texts have none; repeated rows are scanned each; a missing
    path column counts as an empty path.
    """
    path = F.coalesce(F.col(path_column).cast("string"), F.lit("")) if path_column in docs.columns else F.lit("")
    texts = docs.select("doc_id", path.alias("path"), text_or_empty().alias("text"))
    lower = F.lower("text")
    named = reduce(Column.__or__, [F.contains(lower, F.lit(part)) for part in NAME_PARTS])
    texts = texts.withColumn("_named", named).filter(F.col("_named") | F.col("text").rlike("[0-9]"))
    # \G goes on where the last match ended, so a text is passed over once.
    whole, runs = (F.lit(rf"(?s)\G(.*?)({pattern})") for pattern in (CANDIDATE, KEY_RUN))

    def matched(group: int) -> Column:
        named_too = F.regexp_extract_all("text", whole, F.lit(group))
        return F.when(F.col("_named"), named_too).otherwise(F.regexp_extract_all("text", runs, F.lit(group)))

    pieces = texts.withColumns({"_gaps": matched(1), "_found": matched(2)}).filter(F.size("_found") > 0)
    # Gap and candidate lengths, summed up, give the places; the gaps' ends are the neighbouring words.
    lengths = F.zip_with("_gaps", "_found", lambda g, c: F.struct(F.length(g).alias("g"), F.length(c).alias("c")))
    initial = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    places = F.aggregate(
        lengths,
        initial,
        lambda acc, x: F.struct(
            (acc["at"] + x["g"] + x["c"]).alias("at"),
            F.concat(acc["starts"], F.array(acc["at"] + x["g"])).alias("starts"),
        ),
    )
    near = F.lit(CONTEXT)
    placed = pieces.withColumn("_places", places)
    tail = F.substring("text", F.col("_places.at") + 1, near)
    neighbours = placed.select(
        "doc_id",
        "path",
        F.arrays_zip(
            F.col("_places.starts").alias("start"),
            F.col("_found").alias("candidate"),
            F.transform("_gaps", lambda g: F.right(g, near)).alias("before"),
            F.concat(
                F.slice(F.transform("_gaps", lambda g: F.left(g, near)), F.lit(2), F.size("_gaps")), F.array(tail)
            ).alias("after"),
        ).alias("_all"),
    )
    each = neighbours.select("doc_id", "path", F.inline("_all").alias("start", "candidate", "before", "after"))
    return each.select(
        "doc_id",
        "path",
        "candidate",
        F.col("start").cast("long").alias("start"),
        (F.col("start") + F.length("candidate")).cast("long").alias("end"),
        "before",
        "after",
    )


def with_features(found: DataFrame) -> DataFrame:
    """Add the forest's inputs, each a double."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    length = F.length(c)
    switches = r"[A-Z](?=[a-z0-9])|[a-z](?=[A-Z0-9])|[0-9](?=[A-Za-z])"
    rest = F.length(F.regexp_replace(F.lower(c), "|".join(sorted(DICTIONARY, key=len, reverse=True)), ""))
    values = {
        "length": F.least(length, F.lit(200)),
        "digit_share": _share(c, "0-9"),
        "upper_share": _share(c, "A-Z"),
        "lower_share": _share(c, "a-z"),
        "transitions": F.regexp_count(c, F.lit(switches)) / length,
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / F.least(length, F.lit(64)),
        "hexadecimal": c.rlike(r"\A[0-9a-f]+\z|\A[0-9A-F]+\z"),
        "covered": (length - rest) / length,
        "assigned": before.rlike(r"[=:]\s*[\"']?\z"),
        "quoted": before.rlike(r"[\"'`]\z") & after.rlike(r"\A[\"'`]"),
        "secret_word": before.rlike(SECRET_WORDS),
        "plain_word": before.rlike(PLAIN_WORDS),
        "sentence_around": before.rlike(r"[a-zà-ÿ] \z") & after.rlike(r"\A[ .,]"),
        "path_word": F.col("path").rlike(PATH_WORDS),
    }
    return found.withColumns({name: values[name].cast("double") for name in FEATURES})


def weak_label(found: DataFrame) -> DataFrame:
    """Labelled findings where none are given: 1 for published formats and values assigned to a
    secret's name, 0 for numbers, dictionary words and what its neighbours call something else; null for others.
    """
    c, before = F.col("candidate"), F.col("before")
    # Of values that are no long run, ordinary words after a name may be prose; those with a digit are not.
    telling = c.rlike(rf"\A{KEY_RUN}\z") | (c.rlike("[0-9]") & c.rlike("[A-Za-z]"))
    secret = c.rlike(KNOWN_FORMATS) | (before.rlike(SECRET_WORDS) & before.rlike(r"[=:]\s*[\"']?\z") & telling & ~c.rlike(NO_VALUE))
    plain = c.rlike(r"\A[0-9_+/-]+=*\z") | before.rlike(PLAIN_WORDS) | (F.col("covered") > 0.5) | c.rlike(NO_VALUE)
    label = F.when(secret & ~before.rlike(PLAIN_WORDS), 1.0).when(plain, 0.0)
    return found.withColumn("label", label)


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> PipelineModel | None:
    """A forest on a bounded sample of labelled findings (FEATURES and label); None if a class is missing."""
    names = [*FEATURES, "label"]
    sample = labelled.select(*names).orderBy(F.xxhash64(*names)).limit(sample_rows)
    sample = stored(sample, "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        featureSubsetStrategy="sqrt", rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_prediction",
    )
    return PipelineModel([assemble, forest.fit(assemble.transform(sample))])


def scan(docs: DataFrame, labelled: DataFrame | None = None, path_column: str = "source") -> DataFrame:
    """doc_id, start, end, secret_sha256, length, score, is_secret; a row per candidate in ``docs``.

    ``labelled`` are findings with FEATURES and label; without them, those of these documents whose
    format or neighbours tell are used. Where only one class is known, every candidate gets the score
    of that class, and one half where none is. The secret itself is not shown, only its SHA-256.
    """
    # What is stored on the way holds hashes and features only, no secret and no text around it.
    found = weak_label(with_features(candidates(docs, path_column)))
    found = found.withColumns(
        {"secret_sha256": F.sha2(F.col("candidate").cast("binary"), 256), "length": F.length("candidate").cast("long")}
    )
    found = stored(found.select("doc_id", "start", "end", "secret_sha256", F.col("length").alias("n_chars"), *FEATURES, "label"), "candidates")
    known = (found if labelled is None else labelled).filter("label IS NOT NULL")
    model = train(known)
    if model is None:
        prior = known.agg(F.avg("label")).first()[0]
        scored = found.withColumn("score", F.lit(0.5 if prior is None else float(prior)))
    else:
        scored = model.transform(found).withColumn("score", vector_to_array("_probability")[1])
    return scored.select(
        "doc_id",
        "start",
        "end",
        "secret_sha256",
        F.col("n_chars").alias("length"),
        F.round("score", 9).alias("score"),
        (F.col("score") >= THRESHOLD).alias("is_secret"),
    )
