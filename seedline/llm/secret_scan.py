"""Secret scan: candidate strings, a random forest over their shape and surroundings, redaction.

Candidates are runs of letters, digits and a few signs, at least ``LEAST`` characters long, with a digit or an
issuer's prefix: the whole run after its leading signs, its parts around an ``@``, and what begins with an issuer's
prefix after a sign. The quoted or assigned value after a naming word is a candidate whatever its length and signs;
an unquoted one also up to its first ``&``, ``,`` or ``;``. A
forest decides which are secrets, from length, transitions between kinds of characters, coverage by
dictionary words, the path (here the ``source``) and the words next to them. It is trained on labelled findings:
``labelled_findings`` makes a table of them by rule from hashes of row numbers, and any table of the
same columns can be used in its place.

Null and empty texts have no candidates. Every place of a string is judged by its own
neighbours; the string is one finding of the text, at its first place, with the largest probability;
rows equal in text and id give their findings once. Null ids are kept in findings and null texts in redaction.
Only DataFrame and JVM operations are used. Extra columns stay in ``redacted``, whatever their names.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import durable
from .columns import free_prefix, quoted
from .sieve import shared, sieve

LEAST = 12  # characters of a candidate
AROUND = 40  # characters on each side that are looked at
TRAINED_ON = 6000  # findings made by ``labelled_findings``
TREES, DEPTH, SEED = 30, 8, 7
IS_SECRET = 0.5
MASK = "[SECRET]"

ISSUERS = "AKIA|ASIA|gh[pousr]_|glpat-|xox[abp]-|sk_live_|sk-|AIza|eyJ"

# Words that names and addresses are made of, words that stand before secrets, words of harmless places.
DICTIONARY = (
    "about account admin apache api app article auth blog build cache client cloud code com commit config data default demo dev digest doc docs "
    "email error example file get home host http https image index info item key lib license list local login mail main map name net new node "
    "null number order org page password path post public query read report request response route run script secret server service session "
    "set site source static status store string style sub system table tag test text time token true type update url user utf value version "
    "view web width www"
).split()
BEFORE_SECRETS = "token secret password passwd pwd apikey api_key api-key key credential credentials auth bearer access".split()
HARMLESS = "commit sha digest checksum md5 hash uuid id version call phone tel card ip mail".split()
HARMLESS_PATHS = r"(?i)test|example|sample|mock|fixture|docs?\b|\.lock"

# Each pattern has the groups: what stands before the candidate in the match, the candidate, the text after it. No match is empty.
LATER = rf"(?=([\s\S]{{0,{AROUND}}}))"
RUN = rf"(?<![A-Za-z0-9_+/@.-])([_+/@.-]*+)(?=[A-Za-z_+/@.-]*[0-9]|{ISSUERS})([A-Za-z0-9][A-Za-z0-9_+/@.-]{{{LEAST - 2},}}[A-Za-z0-9]){LATER}"
AT_SIGN = (
    rf"(?<![A-Za-z0-9_+/.-])(?:(?<=@)|(?=[A-Za-z0-9_+/.-]++@))([_+/.-]*+)(?=[A-Za-z_+/.-]*[0-9]|{ISSUERS})"
    rf"([A-Za-z0-9][A-Za-z0-9_+/.-]{{{LEAST - 2},}}[A-Za-z0-9]){LATER}"
)
ISSUED = rf"([_+/@.-])(?=[A-Za-z0-9_+/.-]{{{LEAST}}})((?:{ISSUERS})[A-Za-z0-9_+/.-]*[A-Za-z0-9]){LATER}"
NAMING = "|".join(sorted(BEFORE_SECRETS, key=lambda w: (-len(w), w)))
NAMED = rf"((?<![A-Za-z])(?:(?i:{NAMING})[\"']?(?:\s*+[=:]++>?+\s*+|\s++(?=[\"']))|(?i:bearer)\s++)[\"']?+)"
VALUE = rf"{NAMED}(?=((?<=\").+?(?<!\\)(?=\")|(?<=').+?(?<!\\)(?=')|[^\s\"'`]*[^\s\"'`.,;:)\]}}>]){LATER})"
FIRST_VALUE = rf"{NAMED}(?=([^\s\"'`&,;]+(?=[&,;])){LATER})"
PATTERNS = [RUN, AT_SIGN, ISSUED, VALUE, FIRST_VALUE]
NAMED_PATTERNS = [VALUE, FIRST_VALUE]
PLACES = "array<struct<pattern:int,place:int,gap:string,gap_length:bigint,match:string,lead:string,token:string,after:string>>"
LEADING = r"[\s\"':=>_+/@.-]*$"  # between a word and a candidate

FEATURES = [
    "length", "letter_share", "upper_share", "digit_share", "sign_share", "hex_only", "turns", "longest_run", "distinct_share", "coverage", "dots",
    "at_sign", "slashes", "named", "harmless_word", "assigned", "quoted", "issuer", "harmless_path",
]


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.length(text)


def with_features(findings: DataFrame) -> DataFrame:
    """``findings``: token, before, after, path. Adds the columns of FEATURES."""
    t, before = F.col("token"), F.lower("before")
    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    kinds = F.translate(
        F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d"), "_+/@.-", "ssssss"
    )
    name = rf"(?<![a-z])({'|'.join(BEFORE_SECRETS)}){LEADING}"
    columns = {
        "length": F.log(F.length(t)),
        "letter_share": _share(t, "[A-Za-z]"),
        "upper_share": _share(t, "[A-Z]"),
        "digit_share": _share(t, "[0-9]"),
        "sign_share": _share(t, "[^A-Za-z0-9]"),
        "hex_only": t.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "turns": F.regexp_count(kinds, F.lit("(?<=l)[^l]|(?<=u)[^u]|(?<=d)[^d]|(?<=s)[^s]")) / F.length(t),
        "longest_run": F.array_max(F.transform(F.regexp_extract_all(kinds, F.lit("(l+|u+|d+|s+)"), F.lit(1)), lambda x: F.length(x))) / F.length(t),
        "distinct_share": F.size(F.array_distinct(F.split(t, ""))) / F.length(t),
        "coverage": F.lit(1.0) - F.length(F.regexp_replace(F.lower(t), words, "")) / F.length(t),
        "dots": F.regexp_count(t, F.lit(r"\.")).cast("double"),
        "at_sign": t.contains("@").cast("double"),
        "slashes": F.regexp_count(t, F.lit("/")).cast("double"),
        "named": before.rlike(name).cast("double"),
        "harmless_word": before.rlike(rf"(?<![a-z])({'|'.join(HARMLESS)}){LEADING}").cast("double"),
        "assigned": before.rlike(r"[=:]>?\s*[\"']?[_+/@.-]*$").cast("double"),
        "quoted": (before.rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double"),
        "issuer": t.rlike(f"^({ISSUERS})").cast("double"),
        "harmless_path": F.coalesce(F.col("path"), F.lit("")).rlike(HARMLESS_PATHS).cast("double"),
    }
    return findings.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in columns.items()})


def labelled_findings(spark: SparkSession, rows: int = TRAINED_ON) -> DataFrame:
    """token, before, after, path, label: findings by rule, half of them secrets. One partition, so that it repeats."""
    i = F.col("id").cast("string")

    def hashed(salt: str, n: int) -> Column:
        return F.substring(F.sha2(F.concat(F.lit(salt), i), 512), 1, n)

    def drawn(salt: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n))

    def choice(salt: str, values: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (drawn(salt, len(values)) + 1).cast("int"))

    mixed = F.regexp_replace(F.base64(F.unhex(hashed("b", 64))), "=", "")
    upper = F.translate(F.upper(hashed("u", 16)), "01", "YZ")
    spread = F.translate(upper, "23456789", "KQ3W5T7X")
    digits = F.translate(hashed("d", 40), "abcdef", "012345")
    word = [choice(f"w{k}", ["the", "and", "report", "user", "des", "leon", "ver", "einheit", "casa", "order", "mail", "data"]) for k in range(4)]
    sign, phrase_sign = choice("z", list("!#$%&*?^~")), choice("y", ["-", "-", "_", "."])
    secret = F.array(
        hashed("h", 40), hashed("h", 32), hashed("h", 18), hashed("h", 64), F.concat(F.lit("AKIA"), spread), F.concat(F.lit("ghp_"), F.substring(mixed, 1, 36)),
        F.substring(mixed, 1, 24), F.concat(F.lit("sk_live_"), F.substring(mixed, 1, 24)), F.substring(mixed, 1, 40), F.concat(F.lit("AKIA"), upper),
        F.concat(word[0], phrase_sign, word[1], phrase_sign, word[2], phrase_sign, word[3]), F.concat(F.initcap(word[0]), F.substring(digits, 1, 2), sign, F.initcap(word[1]), sign, F.substring(digits, 3, 1)),
        F.concat(F.substring(mixed, 1, 5), sign, F.substring(mixed, 6, 5)), F.concat(F.lit("/"), F.substring(mixed, 1, 39)), F.concat(word[0], F.substring(digits, 1, 3)),
    )
    harmless = F.array(
        F.concat_ws(".", F.substring(digits, 1, 3), F.substring(digits, 4, 2), F.substring(digits, 6, 3), F.substring(digits, 9, 3)),
        F.substring(digits, 1, 16), F.concat(word[0], F.lit("."), F.substring(digits, 1, 2), F.lit("@mail"), F.substring(digits, 3, 1), F.lit(".example.com")),
        F.concat_ws("-", word[0], word[1], word[2], F.substring(digits, 1, 2)), F.concat_ws("/", word[0], word[1], F.concat(word[2], F.substring(digits, 1, 3), F.lit(".html"))),
        hashed("h", 40), hashed("h", 32), F.concat_ws("-", hashed("a", 8), hashed("b", 4), hashed("c", 4), hashed("e", 12)),
        F.concat(F.lit("20"), F.substring(digits, 1, 2), F.lit("-0"), F.substring(digits, 3, 1), F.lit("-1"), F.substring(digits, 4, 1), F.lit("T1"), F.substring(digits, 5, 1)),
        F.concat(word[0], F.initcap(word[1]), F.initcap(word[2]), F.substring(digits, 1, 1)),
        word[0], choice("v", ["null", "none", "true", "required", "string", "optional", "<your-value>", "********", "${VALUE}", "[SECRET]", "1", "0"]),
        F.concat(word[0], F.lit("."), word[1], F.lit("("), word[2], F.lit(")")), F.concat(F.lit("mail"), F.substring(digits, 3, 1), F.lit(".example.com")), F.concat_ws("_", word[0], word[1]),
    )
    label = F.col("id") % 2
    kind = (drawn("kind", 15) + 1).cast("int")
    by_issuer = kind.isin(5, 6, 8, 10)
    named = F.concat(choice("n", ["token", "secret", "password", "api_key", "key", "auth", "access", "apikey"]), choice("q", [" = \"", "=", ": ", "=\"", ": '", " = "]))
    named_bare = F.when(kind == 12, named).otherwise(F.concat(choice("n", ["token", "secret", "password", "api_key", "key", "auth", "access", "apikey"]), choice("q", ["=", ": ", " = "])))
    plain = F.concat_ws(" ", word[1], word[3], F.lit(""))
    told = F.concat(choice("c", ["commit ", "sha ", "digest: ", "checksum=", "md5: ", "hash ", "call ", "version "]), F.lit(""))
    before = F.when(label == 1, F.when(by_issuer & (drawn("p", 2) == 0), plain).otherwise(F.concat(plain, named)))
    before = before.otherwise(F.when(kind.isin(11, 12, 13, 15), F.concat(plain, named_bare)).when(kind == 14, F.concat(plain, word[3], F.lit("@"))).when(kind.isin(6, 7), F.concat(plain, told)).when(drawn("p", 3) == 0, F.concat(plain, told)).otherwise(plain))
    rows_ = spark.range(0, rows, 1, 1).select(
        F.element_at(F.when(label == 1, secret).otherwise(harmless), kind).alias("token"),
        before.alias("before"),
        F.when(F.substring(before, -1, 1).isin('"', "'"), F.concat(F.substring(before, -1, 1), F.lit(" "), word[2])).otherwise(F.concat(F.lit(" "), word[2])).alias("after"),
        F.when((label == 0) & (drawn("t", 4) == 0), "docs/example").otherwise(F.concat(F.lit("src"), drawn("s", 20).cast("string"))).alias("path"),
        label.cast("double").alias("label"),
    )
    return rows_


def train(findings: DataFrame) -> RandomForestClassificationModel:
    """A forest over labelled findings; their number is bounded by the caller (``TRAINED_ON`` by default)."""
    table = VectorAssembler(inputCols=FEATURES, outputCol="_sv").transform(with_features(findings)).select("_sv", "label")
    forest = RandomForestClassifier(featuresCol="_sv", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
    return forest.fit(table)


def _may_hold_runs(text: Column) -> Column:
    """Every run that is a candidate has a digit or an issuer's prefix."""
    return text.rlike("[0-9]") | text.rlike(ISSUERS)


def _may_name(text: Column) -> Column:
    """Every named value stands after a naming word and a sign, or after the last of these words alone."""
    signs = text.contains("=") | text.contains(":") | text.contains('"') | text.contains("'") | text.rlike(r"(?i)bearer\s")
    return signs & text.rlike(f"(?i){NAMING}")


def candidates(docs: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """doc_id, text_key, path, token, start (characters before it), before, after; a row per place and pattern."""
    whole = F.coalesce(F.col(text), F.lit(""))
    held = docs.select("doc_id", F.md5(F.col(text)).alias("text_key"), F.col(path).alias("path"), whole.alias("_sw"), F.monotonically_increasing_id().alias("_sr"))

    def places(number: int, pattern: str) -> Column:
        """Of each match, and of what stands behind the last one: what is before it, its parts, what is after its candidate."""
        match = F.regexp_extract_all("_sw", F.lit(pattern), F.lit(0))
        if pattern in NAMED_PATTERNS:
            groups = [match, *[F.regexp_extract_all("_sw", F.lit(pattern), F.lit(g)) for g in (2, 3)]]
        else:  # the match is the leading signs and the candidate, so that only what comes after it has to be looked up
            groups = [match, F.transform(match, lambda m: F.regexp_extract(m, "^[_+/@.-]*", 0)), F.regexp_extract_all("_sw", F.lit(pattern), F.lit(3))]
        # the text split by the pattern has a piece more than there are matches
        names = ("match", "token", "after") if pattern in NAMED_PATTERNS else ("match", "lead", "after")
        zipped = F.arrays_zip(F.split("_sw", pattern, -1), *groups).cast(f"array<struct<gap:string,{','.join(f'{n}:string' for n in names)}>>")
        lead, token = (lambda x: x["match"], lambda x: x["token"]) if pattern in NAMED_PATTERNS else (lambda x: x["lead"], lambda x: F.substr(x["match"], F.length(x["lead"]) + 1))
        return F.transform(zipped, lambda x, i: F.struct(
            F.lit(number).alias("pattern"), i.alias("place"), F.right(x["gap"], F.lit(AROUND)).alias("gap"), F.length(x["gap"]).cast("bigint").alias("gap_length"),
            x["match"].alias("match"), lead(x).alias("lead"), token(x).alias("token"), x["after"].alias("after"),
        )).cast(PLACES)

    # a text without what a pattern needs is not searched for it
    held = held.withColumns({"_s0": _may_hold_runs(F.col("_sw")), "_s2": F.col("_sw").rlike(rf"[_+/@.-](?:{ISSUERS})"), "_s3": _may_name(F.col("_sw"))})
    needs = [F.col("_s0"), F.col("_s0") & F.col("_sw").contains("@"), F.col("_s2"), F.col("_s3"), F.col("_s3")]
    every = F.concat(*[F.coalesce(F.when(need, places(n, p)), F.array().cast(PLACES)) for n, (need, p) in enumerate(zip(needs, PATTERNS))])
    rows = held.where("_s0 OR _s2 OR _s3").select("doc_id", "text_key", "path", "_sr", F.explode(every).alias("f")).select("doc_id", "text_key", "path", "_sr", "f.*").where("token IS NOT NULL")
    earlier = Window.partitionBy("_sr", "pattern").orderBy("place")
    passed = F.coalesce(F.sum(F.col("gap_length") + F.length("match")).over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # every place before adds a character at least
    tails = F.collect_list(F.right(F.concat("gap", "match"), F.lit(AROUND))).over(earlier.rowsBetween(-AROUND, -1))
    return rows.select(
        "doc_id", "text_key", "path", "token", (passed + F.col("gap_length") + F.length("lead")).cast("bigint").alias("start"),
        F.right(F.concat(F.array_join(tails, ""), F.col("gap"), F.col("lead")), F.lit(AROUND)).alias("before"), "after",
    )


def findings(docs: DataFrame, text: str = "text", path: str = "source", model: RandomForestClassificationModel | None = None) -> DataFrame:
    """doc_id, text_key, token, start, probability of the candidates that are secrets; one row per id, text and string."""
    model = model or train(labelled_findings(docs.sparkSession))
    measured = durable(with_features(candidates(docs, text, path)), "secret-candidates")
    judged = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="_sv").transform(measured))
    judged = judged.withColumn("probability", F.get(vector_to_array("probability"), F.lit(1)))
    strings = judged.groupBy("doc_id", "text_key", "token").agg(F.min("start").alias("start"), F.max("probability").alias("probability"))
    return strings.where(F.col("probability") >= IS_SECRET).select("doc_id", "text_key", "token", "start", "probability")


def _masked(text: Column, secret: Column) -> Column:
    """Short strings are masked as words of their own only, as they also stand in longer ones."""
    quoted = F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), F.replace(secret, F.lit("\\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![\p{L}\p{N}])"))
    return F.when(F.length(secret) < LEAST, F.regexp_replace(text, quoted, F.lit(MASK))).otherwise(F.replace(text, secret, F.lit(MASK)))


def redacted(docs: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """``docs`` with every occurrence of a found secret masked, and ``n_chars``, if there, brought up to date.

    Texts outside the sieve of those with secrets pass as they are; only the others are joined with their secrets."""
    p = free_prefix(docs)
    secrets = findings(docs, text, path).groupBy(F.col("text_key").alias(f"{p}key")).agg(F.collect_set(F.struct(F.length("token").alias("n"), "token")).alias("found"))
    secrets = secrets.select(f"{p}key", F.sort_array("found", asc=False)["token"].alias(f"{p}found"))  # a string before those inside it
    secrets = durable(secrets, "secrets-by-text")
    keyed = docs.withColumn(f"{p}key", F.coalesce(F.md5(F.col(text)), F.lit("")))
    marked = shared(keyed, durable(sieve(secrets, f"{p}key", least=1), "secrets-sieve"), f"{p}hit", f"{p}key")
    joined = marked.where(f"{p}hit").join(secrets, f"{p}key", "left")
    masked = F.aggregate(F.coalesce(f"{p}found", F.array().cast("array<string>")), F.col(text), _masked)
    out = joined.withColumn(text, F.when(F.col(f"{p}found").isNull(), F.col(text)).otherwise(masked))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(f"{p}found").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("bigint")))
    return marked.where(~F.col(f"{p}hit")).select(*quoted(docs)).unionByName(out.select(*quoted(docs)))
