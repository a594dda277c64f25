"""Secret scans: candidates judged by a random forest that was trained on labelled findings to remove false positives.

Candidates are long runs of key characters and what is assigned to a credential's name. Expressions over one document
find and judge them; only counts of words and a bounded sample of labelled findings are gathered to learn the forest.
"""

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import aside, stage, whole_text, with_text
from shelfwise.llm.pii import running_start

#: Words that name credentials, and words beside harmless identifiers.
_CREDENTIAL = r"token|secret|passw(?:or)?d|passwd|pwd|passphrase|api.?key|access.?key|private.?key|auth|bearer|credential"
_IDENTIFIER = r"commit|revision|sha-?1|sha-?256|sha-?512|md5|crc|checksum|digest|fingerprint|hash|uuid|guid|build|version|order|image|base64"
NAMES_SECRET, NAMES_HARMLESS = f"(?i){_CREDENTIAL}", f"(?i){_IDENTIFIER}|example|card|phone"
#: A candidate: at least 16 key characters in a row, possibly padded, or six or more signs assigned to a credential's name.
CANDIDATE = (
    r"(?:(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}"
    r"|(?<=[\"' :=])(?<=(?i:token|secret|passw(?:or)?d|passwd|pwd|passphrase|api.?key)[\"']{0,1} {0,1}[:=]{1,2}>{0,1} {0,1}[\"']{0,1})[^\s\"'<>,;]{6,64})"
)
#: A credential's name, or a harmless identifier's, an assignment sign and maybe a quote right before the candidate.
ASSIGNED = rf"(?i)(?:{_CREDENTIAL})[A-Za-z_]*[\"']? ?(?::|=|=>|:=) ?[\"']?$"
IDENTIFIED = rf"(?i)(?:{_IDENTIFIER})[A-Za-z_]*[\"']? ?(?::|=|=>|:=|,|/)? ?[\"']?$"
#: What stands where a secret belongs.
PLACEHOLDER = r"(?i)your|example|sample|placeholder|change.?me|dummy|redacted|goes.?here|insert|not.?set|xxxx|\*\*\*|^(.)\1+$|^(?:none|null|true|false|undefined)$"
WORDS = r"^(?:[A-Za-z]?[a-z]+(?:[._/-][A-Za-z]?[a-z]+)*|[A-Za-z]?[a-z_-]+|[A-Z_-]+|[0-9_+-]+|[^A-Za-z0-9]+)=*$"
CONTEXT = 40
#: Frequent words of the corpus that make the dictionary, and labelled findings of each class that are learned from.
DICTIONARY_WORDS, MAX_FINDINGS = 300, 20_000
#: Findings made from the templates below, and the share of all findings that is held out.
SEEDED, FOLDS = 4_000, 5
TREES, DEPTH, FEATURE_SHARE = 20, 8, 0.7
FEATURES = ("length", "transitions", "digits", "uppers", "distinct", "vowels", "covered", "longest_word", "dashes", "quoted", "named_secret", "named_harmless", "path_depth", "path_of_tests")
SECRET_FROM = 0.5


def dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> list[str]:
    """The corpus's most frequent lower-case words of 3 to 10 letters, counted over all documents."""
    seen = docs.select(F.explode(F.regexp_extract_all(F.lower(whole_text()), F.lit(r"\b([a-z]{3,10})\b"), F.lit(1))).alias("word"))
    top = seen.groupBy("word").count().orderBy(F.desc("count"), "word").limit(words)
    return [r["word"] for r in top.collect()]


def candidates(text: Column) -> tuple[Column, Column]:
    """The candidates of a text and the pieces between them."""
    return F.regexp_extract_all(text, F.lit(f"({CANDIDATE})"), F.lit(1)), F.split(text, CANDIDATE, -1)


def _share(count: Column, value: Column) -> Column:
    return count / F.length(value)


def measures(value: Column, before: Column, after: Column, path: Column, known: list[str]) -> list[Column]:
    """The features of a candidate as doubles, in the order of FEATURES.

    Its length; changes between classes of characters; shares of digits, capitals, distinct characters, vowels,
    characters in dictionary words, its longest run of small letters and signs between words; whether it is quoted;
    neighbouring words that name credentials or identifiers; what its path looks like. What labels a finding,
    the assignment right before it, is not among them.
    """
    words = "|".join(sorted(known, key=lambda w: (-len(w), w))) or "(?!)"
    near = F.concat(before, F.lit(" "), after)
    made = [
        F.length(value),
        _share(F.regexp_count(value, F.lit(r"[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])")), value),
        _share(F.regexp_count(value, F.lit("[0-9]")), value),
        _share(F.regexp_count(value, F.lit("[A-Z]")), value),
        _share(F.size(F.array_distinct(F.split(value, ""))), value),
        _share(F.regexp_count(value, F.lit("(?i)[aeiou]")), value),
        1 - _share(F.length(F.regexp_replace(F.lower(value), words, "")), value),
        _share(F.array_max(F.transform(F.split(value, "[^a-z]+"), F.length)), value),
        F.regexp_count(value, F.lit("[._/-]")),
        F.when(before.rlike("[\"']$"), 1).otherwise(0),
        F.when(near.rlike(NAMES_SECRET), 1).otherwise(0),
        F.when(near.rlike(NAMES_HARMLESS), 1).otherwise(0),
        F.regexp_count(path, F.lit("/")),
        F.when(path.rlike("(?i)test|example|sample|fixture|doc"), 1).otherwise(0),
    ]
    return [m.cast("double") for m in made]


def weak_labels(value: Column, before: Column) -> Column:
    """Labels where none were given by hand, from what stands right before a finding and from its form.

    0 for placeholders, plain words, numbers and signs, and after a harmless identifier's name; else 1 after a
    credential's name and assignment; null for all else, which is left to the forest.
    """
    return F.when(value.rlike(PLACEHOLDER) | value.rlike(WORDS) | before.rlike(IDENTIFIED), 0).when(before.rlike(ASSIGNED), 1)


#: Labelled findings as texts before, forms of the value and label; {} is where the value stands.
_KEYS = ("hex32", "hex40", "hex64", "base40", "prefixed", "upper20", "mixed12")
TEMPLATES = [
    *((text, form, 1) for text in ('token = "{}"', "password: {}", "SECRET_ACCESS_KEY={}", '"api_key": "{}"', "Authorization: Bearer {}", "auth_token='{}'") for form in _KEYS),
    *((text, form, 0) for text in ("commit {}", "sha256 checksum: {}", "md5 = {}", "revision {} merged", "digest: {}", "build {}", "see {} in the log") for form in ("hex32", "hex40", "hex64")),
    *((text, form, 0) for text in ("uuid {}", 'id="{}"', "request {}") for form in ("uuid", "long_number")),
    *((text, form, 0) for text in ('token = "{}"', "password: {}", '"api_key": "{}"', "secret={}") for form in ("placeholder", "words", "stars")),
    *((text, form, 0) for text in ("the {} of", "import {}", "in {} and") for form in ("words", "path", "long_number")),
    *((text, form, 0) for text in ("the token for card {}", "lost password and {} again", 'api key", {} "', "secret {}") for form in ("words", "path", "long_number")),
    ("image/png;base64,{}", "base40", 0),
]


def _values(spark: SparkSession) -> dict[str, Column]:
    """A value of each form, made from the column `id`."""
    salted = lambda s: F.concat(F.lit(s), F.col("id").cast("string"))
    hex64 = F.sha2(salted("a"), 256)
    base = F.regexp_replace(F.base64(F.unhex(F.sha2(salted("b"), 256))), "[^A-Za-z0-9]", "k")
    words = F.array(*map(F.lit, ("service", "customer", "internal", "default", "handler", "configuration", "review", "transport", "morning", "account")))
    pick = lambda k: F.get(words, (F.pmod(F.xxhash64(salted(str(k))), F.lit(10))).cast("int"))
    stand = F.array(*map(F.lit, ("your-api-key-goes-here-please", "changeme-changeme", "example-token-value", "insert_secret_here_now", "dummy_password_value", "YOUR_TOKEN_PLACEHOLDER")))
    return {
        "hex32": F.md5(salted("c")), "hex40": F.substring(hex64, 1, 40), "hex64": hex64, "base40": F.substring(base, 1, 40),
        "prefixed": F.concat(F.lit("ghp_"), F.substring(base, 2, 36)), "upper20": F.concat(F.lit("AKIA"), F.upper(F.substring(base, 3, 16))),
        "mixed12": F.substring(base, 5, 12), "long_number": F.substring(F.regexp_replace(F.sha2(salted("n"), 512), "[a-f]", "7"), 1, 18),
        "uuid": F.regexp_replace(F.md5(salted("u")), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), "placeholder": F.get(stand, F.pmod(F.xxhash64(salted("p")), F.lit(6)).cast("int")),
        "words": F.concat_ws("-", pick(1), pick(2), pick(3)), "path": F.concat_ws("/", F.lit("src"), pick(4), pick(5), pick(6)), "stars": F.repeat(F.lit("x"), 20),
    }


def seeded(spark: SparkSession, n: int = SEEDED) -> DataFrame:
    """value, before, after, path, label: labelled findings made from TEMPLATES, each in its turn."""
    forms = _values(spark)
    place = {form: i for i, form in enumerate(forms)}
    which = F.pmod(F.col("id"), F.lit(len(TEMPLATES))).cast("int")
    of = lambda column: F.get(F.array(*[F.lit(v) for v in column]), F.col("k"))
    own = spark.range(n).withColumn("k", which).select(
        F.get(F.array(*forms.values()), of([place[form] for _, form, _ in TEMPLATES])).alias("value"), of([text.split("{}")[0] for text, _, _ in TEMPLATES]).alias("before"),
        of([text.split("{}")[1] for text, _, _ in TEMPLATES]).alias("after"), F.lit("").alias("path"), of([label for _, _, label in TEMPLATES]).alias("label"),
    )
    return stage(own, "seeded")


def is_held_out(value: Column) -> Column:
    """Findings that the forest doesn't see: one in FOLDS, by a hash of the value."""
    return F.pmod(F.xxhash64(F.lit("fold"), value), F.lit(FOLDS)) == 0


def findings(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """value, before, after, path of every candidate of `docs`."""
    finds, parts = candidates(F.col("__text"))
    where = F.lit("") if path is None else F.coalesce(F.col(path).cast("string"), F.lit(""))
    own = docs.select(whole_text().alias("__text"), where.alias("path")).where(F.col("__text").rlike(CANDIDATE))
    own = own.select("path", finds.alias("finds"), parts.alias("parts"))
    one = F.transform("finds", lambda v, i: _context(v, F.col("finds"), F.col("parts"), i))
    return own.select("path", F.explode(one).alias("one")).select("one.value", "one.before", "one.after", "path")


def _context(value: Column, finds: Column, parts: Column, i: Column) -> Column:
    """The value and CONTEXT characters of the text on both sides of it.

    Neighbouring candidates are part of them: a long credential name is one. Three of them are longer than CONTEXT.
    """
    piece = lambda cut, of, at: F.coalesce(cut(F.get(of, at), F.lit(CONTEXT)), F.lit(""))
    ahead = [piece(F.right, of, i - k) for k in (3, 2, 1) for of in (parts, finds)][1:] + [piece(F.right, parts, i)]
    behind = [piece(F.left, of, i + k) for k in (1, 2, 3) for of in (parts, finds)]
    return F.struct(
        value.alias("value"), F.right(F.concat(*ahead), F.lit(CONTEXT)).alias("before"), F.left(F.concat(*behind), F.lit(CONTEXT)).alias("after")
    )


class Forest:
    """A trained forest as nested conditions: one expression per tree, averaged."""

    def __init__(self, trees: list, known: list[str]):
        self.trees, self.known = trees, known

    def score(self, value: Column, before: Column, after: Column, path: Column) -> Column:
        """Probability of a real secret."""
        made = F.array(*measures(value, before, after, path, self.known))

        def walk(node, x: Column) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, cut, left, right = node
            return F.when(F.get(x, F.lit(feature)) <= cut, walk(left, x)).otherwise(walk(right, x))

        # bound once, so that the trees don't measure anew
        votes = F.transform(F.array(made), lambda x: sum((walk(t, x) for t in self.trees[1:]), walk(self.trees[0], x)) / len(self.trees))
        return F.get(votes, F.lit(0))


def _tree(node) -> list | float:
    if node.subtreeDepth() == 0:
        stats = node.impurityStats()
        counts = [stats.stats()[i] for i in range(2)]
        return float(counts[1] / sum(counts)) if sum(counts) else 0.0
    split = node.split()
    return [split.featureIndex(), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())]


def measured(labelled: DataFrame, known: list[str]) -> DataFrame:
    """label and the features of findings (value, before, after, path, label), as a vector beside their columns."""
    columns = measures(F.col("value"), F.col("before"), F.col("after"), F.col("path"), known)
    rows = labelled.select("*", *(c.alias(f"_{n}") for c, n in zip(columns, FEATURES, strict=True)))
    return VectorAssembler(inputCols=[f"_{n}" for n in FEATURES], outputCol="features").transform(rows.withColumn("label", F.col("label").cast("double")))


def train_forest(labelled: DataFrame, known: list[str], max_findings: int = MAX_FINDINGS) -> tuple["Forest", RandomForestClassificationModel | None]:
    """Learns from labelled findings (value, before, after, path, label), at most `max_findings` different ones per class.

    With findings of one class only there is nothing to learn; every finding then has that class.
    """
    each = labelled.where("label is not null").groupBy("value", "before", "after", "path").agg(F.max("label").alias("label"))
    picked = [each.where(F.col("label") == k).orderBy(F.xxhash64("value", "before", "after"), "path").limit(max_findings) for k in (0, 1)]
    rows = stage(measured(picked[0].unionByName(picked[1]), known).select("label", "features"), "findings")
    classes = [r[0] for r in rows.select("label").distinct().collect()]
    if len(classes) < 2:
        return Forest([float(classes[0]) if classes else 0.0], known), None
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy=str(FEATURE_SHARE)).fit(rows)
    return Forest([_tree(t.rootNode()) for t in model._java_obj.trees()], known), model


def labelled_findings(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """The documents' own findings with their weak labels, and the seeded ones."""
    own = findings(docs, path)
    own = own.withColumn("label", weak_labels(F.col("value"), F.col("before")))
    return own.unionByName(seeded(docs.sparkSession)).where("label is not null")


def learn(docs: DataFrame, path: str | None = "source") -> "Forest":
    """A forest from the labelled findings that are not held out."""
    return train_forest(labelled_findings(docs, path).where(~is_held_out(F.col("value"))), dictionary(docs))[0]


def held_out_quality(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """One row: precision, recall, n_secret, n_harmless of the forest on the different findings that are held out."""
    forest, every = learn(docs, path), labelled_findings(docs, path).where(is_held_out(F.col("value"))).distinct()
    said = forest.score(F.col("value"), F.col("before"), F.col("after"), F.col("path")) >= SECRET_FROM
    judged = every.select("label", said.alias("said"))
    hit = F.count_if(F.col("said") & (F.col("label") == 1))
    return judged.agg(
        F.try_divide(hit, F.count_if("said")).alias("precision"), F.try_divide(hit, F.count_if(F.col("label") == 1)).alias("recall"),
        F.count_if(F.col("label") == 1).alias("n_secret"), F.count_if(F.col("label") == 0).alias("n_harmless"),
    )


def find_secrets(docs: DataFrame, forest: Forest, path: str | None = "source", name: str = "candidates") -> DataFrame:
    """All rows and columns of `docs` with `name`: array of (start, stop, score); code points, stop exclusive.

    A null text counts as empty, a null path as none; a column `name` of `docs` is replaced. Rows stay where they
    are, so hot values don't matter.
    """
    docs, back = aside(docs)
    where = F.lit("") if path is None else F.coalesce(F.col(path).cast("string"), F.lit(""))
    finds, _ = candidates(F.col("__text"))
    none = F.array().cast("array<string>")
    found = docs.withColumns({"__text": whole_text(), "__path": where})
    found = found.withColumn("__finds", finds)
    found = found.withColumn("__parts", F.when(F.size("__finds") > 0, F.col("__text")).otherwise(F.lit("")))
    found = found.withColumn("__parts", F.when(F.size("__finds") > 0, F.split("__parts", CANDIDATE, -1)).otherwise(none))
    gaps = F.transform("__finds", lambda v, i: F.char_length(F.get("__parts", i)) + F.char_length(v))
    found = found.withColumn("__before", running_start(gaps))
    begin = lambda i: (F.get("__before", i) + F.char_length(F.get("__parts", i))).cast("int")
    placed = F.transform(
        "__finds",
        lambda v, i: F.struct(begin(i).alias("start"), (begin(i) + F.char_length(v)).alias("stop"), _context(v, F.col("__finds"), F.col("__parts"), i).alias("c")),
    )
    judged = F.transform(
        placed, lambda p: F.struct(p["start"], p["stop"], forest.score(p["c"]["value"], p["c"]["before"], p["c"]["after"], F.col("__path")).alias("score"))
    )
    found = found.withColumn("__candidates", judged).drop(*[c for c in [name] if c in found.columns], "__text", "__path", "__finds", "__parts", "__before")
    return back(found.withColumnRenamed("__candidates", name))


def redact(docs: DataFrame, path: str | None = "source", mark: str = "<secret>") -> DataFrame:
    """`docs` with each secret replaced by `mark`, n_chars following; documents without one stay as they are."""
    forest = learn(docs, path)
    docs, back = aside(docs)
    found = find_secrets(docs, forest, path, "candidates__").withColumn("__secrets", F.filter("candidates__", lambda c: c["score"] >= SECRET_FROM))
    n = F.size("__secrets")
    text = F.col("text")
    starts = F.concat(F.array(F.lit(0)), F.transform("__secrets", lambda s: s["stop"]))
    stops = F.concat(F.transform("__secrets", lambda s: s["start"]), F.array(F.char_length(text)))
    kept = F.transform(F.sequence(F.lit(0), n), lambda i: F.substring(text, F.get(starts, i) + 1, F.get(stops, i) - F.get(starts, i)))
    return back(with_text(found, n > 0, F.array_join(kept, mark), docs.columns))


def secret_report(docs: DataFrame) -> DataFrame:
    """Per document: candidates, secrets, their spans as start:stop and the highest score."""
    found = find_secrets(docs.select("doc_id", "text", "source"), learn(docs.select("text", "source")))
    secrets = F.filter("candidates", lambda c: c["score"] >= SECRET_FROM)
    return found.select(
        "doc_id", F.size("candidates").cast("long").alias("n_candidates"), F.size(secrets).cast("long").alias("n_secrets"),
        F.array_join(F.transform(secrets, lambda c: F.concat_ws(":", c["start"].cast("string"), c["stop"].cast("string"))), ",").alias("spans"),
        F.coalesce(F.array_max(F.transform("candidates", lambda c: c["score"])), F.lit(0.0)).alias("top_score"),
    )
