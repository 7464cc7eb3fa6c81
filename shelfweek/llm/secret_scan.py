"""Secret scan: long tokens, tokens with a known beginning and values after an assignment or
a telling word are candidates, a random forest drops the false ones.

Built-in functions and Spark's own forest; no Python touches a row. The forest is learned
from labelled findings (a token, what stands before and after it, secret or not) and turned
into one expression, so that scanning is a projection and a document never leaves its task.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text_spans

#: Characters before and after a candidate that are looked at. They reach no further than
#: the next candidate.
NEARBY = 40
#: Words of the dictionary: the most frequent of 3 to 8 letters, over all texts.
DICTIONARY = 1000
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5

# fixed values
_TOLD = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_ -]?key|auth|bearer|credential|private)s?"
TELLING = rf"(?i){_TOLD}(?:\s+(?:is|was))?[^\p{{L}}]*$"
EXCUSING = r"(?i)(?:commit|sha-?[0-9]*|md5|digest|checksum|etag|uuid|hash|revision|version|order|build)[^\p{L}]*$"
EMBEDDING = r"(?i)(?:;base64,|[?&]v=|integrity=[\"']?|-----BEGIN [A-Z ]{0,30})$"
KNOWN = r"(?<![A-Za-z0-9])(?:AKIA|ASIA|AIza|ghp_|gho_|xox[abp]-|sk_|sk-|eyJ)"

# a known beginning is a candidate of its own, whatever it is joined to
_BEGINNING = rf"{KNOWN}[A-Za-z0-9_-]{{12}}"
# a value of six characters and more ends before space, quotes, closing marks, a tag and the
# next name with a value; one that is a name with a value of its own, or a telling word, leaves
# that value to be found
_END = r"[.,:;)\]}]{0,9}+(?:[\s\"']|\z)|[&,;][\w.-]{0,40}+[=:]|</?[A-Za-z]"
_VALUE = (
    rf"(?![(\[{{/])(?![\w-]*+\s?[=:]\s?[\"']?[^\s\"'=])(?!(?i:{_TOLD})(?:\P{{L}}|\z))"
    rf"(?:(?!{_BEGINNING})(?!{_END})[^\s\"']){{6,}}+"
)
# what holds for all comes first, as most places fail it
_KEY = r"(?:[A-Z0-9]{1,10} ){0,3}PRIVATE KEY-----"
CANDIDATE = r"(?<![A-Za-z0-9])(?=[^\s\"']{6})(?:%s)" % "|".join(
    [
        # a private key from its first line to its last; the password in a connection string
        rf"-----BEGIN {_KEY}[A-Za-z0-9+/=\s]{{40,}}+-----END {_KEY}",
        r"(?<=:)(?<=://[^\s:/@\"']{1,40}:)[^\s/@\"']{6,}+(?=@)",
        # dotted tokens
        r"eyJ[A-Za-z0-9_-]{5,}+(?:\.[A-Za-z0-9_-]*+){1,3}\.[A-Za-z0-9_-]++",
        r"(?<![+/_.-])[A-Za-z0-9_-]{16,}+\.[A-Za-z0-9_-]{4,}+\.[A-Za-z0-9_-]{16,}+",
        rf"{_BEGINNING}[A-Za-z0-9+/_-]*+={{0,2}}",
        # assigned: in quotes, without; after a telling word
        r"(?<=[=:]\s?[\"'])[^\s\"']{6,}+(?=[\"'])",
        rf"(?<=[=:\"'\s])(?<=[=:]\s?[\"']?){_VALUE}",
        rf"(?<=[\"'\s])(?<=(?i:{_TOLD})(?:\s(?:is|was))?[^\p{{L}}\p{{N}}\s]{{0,2}}\s{{0,2}}[\"']?){_VALUE}",
        rf"(?<![+/_-])(?=[A-Za-z0-9+/_-]{{16}})(?:(?!{_BEGINNING})[A-Za-z0-9+/_-]){{16,}}+={{0,2}}",
    ]
)

FEATURES = [
    "length", "digits", "uppers", "lowers", "transitions", "distinct", "hex", "dictionary",
    "known", "slashes", "joints", "path", "telling", "excusing", "assigned", "quoted",
    "others", "dots", "block", "login", "embedded",
]


def _share(token: Column, pattern: str) -> Column:
    return F.regexp_count(token, F.lit(pattern)) / F.length(token)


def _flag(condition: Column) -> Column:
    return condition.cast("double")


def features(before: Column, token: Column, after: Column, trigrams: list[str]) -> Column:
    """Struct of FEATURES for a token between two stretches of text."""
    low = F.lower(token)
    places = F.sequence(F.lit(1), F.length(token) - 2)
    known = F.filter(places, lambda i: F.substr(low, i, F.lit(3)).isin(trigrams or [""]))
    turn = r"[a-z](?=[A-Z0-9])|[A-Z](?=[0-9])|[0-9](?=[A-Za-z])|[A-Z](?=[a-z][A-Z0-9])"
    values = {
        "length": F.length(token).cast("double"),
        "digits": _share(token, "[0-9]"),
        "uppers": _share(token, "[A-Z]"),
        "lowers": _share(token, "[a-z]"),
        "transitions": _share(token, turn),
        "distinct": F.size(F.array_distinct(F.split(token, ""))) / F.length(token),
        "hex": _flag(token.rlike("^[0-9a-f]*$")),
        "dictionary": F.size(known) / F.greatest(F.size(places), F.lit(1)),
        "known": _flag(token.rlike(KNOWN)),
        "slashes": _share(token, "/"),
        "joints": _share(token, "[_-]"),
        "others": _share(token, "[^A-Za-z0-9+/_.=-]"),
        "dots": _share(token, r"\."),
        "path": _flag(before.rlike(r"[/\\.~]$") | token.startswith("/") | after.rlike(r"^\.[a-z]")),
        "telling": _flag(before.rlike(TELLING)),
        "excusing": _flag(before.rlike(EXCUSING)),
        "assigned": _flag(before.rlike(r"[=:]\s*[\"']?$")),
        "block": _flag(token.startswith("-----BEGIN")),
        "login": _flag(before.rlike(r"://[^\s:/@]{1,40}:$") & after.startswith("@")),
        "embedded": _flag(before.rlike(EMBEDDING) | token.rlike("^(?:sha(?:256|384|512)-|data:[a-z]+/)")),
        "quoted": _flag(before.rlike(r"[\"']$") & after.rlike(r"^[\"']")),
    }
    return F.struct(*[values[name].cast("double").alias(name) for name in FEATURES])


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The most frequent words of 3 to 8 letters (a to z) in all texts, most frequent first."""
    words = F.regexp_extract_all(
        F.lower(F.col(text_col).cast("string")), F.lit(r"(?<![\p{L}0-9])[a-z]{3,8}+(?![\p{L}0-9])"), F.lit(0)
    )
    counted = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    rows = counted.orderBy(F.desc("n"), "word").limit(size).collect()  # `size` rows
    return [r.word for r in rows]


def trigrams_of(words: list[str]) -> list[str]:
    return sorted({w[k : k + 3] for w in words for k in range(len(w) - 2)})


def made_findings(spark: SparkSession, words: list[str], per_kind: int = 200) -> DataFrame:
    """(kind, before, token, after, is_secret): labelled findings made by rule from digests,
    for use where no reviewed findings are at hand. Plain words come from ``words``."""
    words = (words or ["lorem", "ipsum", "dolor", "amet"])[:300]
    listed = F.array(*[F.lit(w) for w in words])

    def at_random(salt, below):
        return F.pmod(F.xxhash64(F.lit(salt), F.col("id")), F.lit(below)).cast("int")

    def digest(salt):
        return F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 512)

    drawn = spark.range(per_kind).select(
        *[F.get(listed, at_random(f"w{i}", len(words))).alias(f"w{i}") for i in range(16)],
        digest("hex").alias("hex"),
        F.regexp_replace(F.base64(F.unhex(digest("mixed"))), "[\r\n]", "").alias("mixed"),
        F.lpad(F.abs(F.xxhash64(F.lit("number"), F.col("id"))).cast("string"), 19, "4").alias("number"),
        at_random("size", 32).alias("size"),
    )

    def some(first, count, glue):
        return F.concat_ws(glue, *[F.col(f"w{i}") for i in range(first, first + count)])

    def size(shortest, more):
        return F.lit(shortest) + F.col("size") % more

    def hexed(shortest, more=1):
        return F.left("hex", size(shortest, more))

    letters = F.regexp_replace("mixed", "[+/=]", "q")

    def mixed(shortest, more=1):
        return F.left(letters, size(shortest, more))

    text, close, quote = F.concat(some(0, 4, " "), F.lit(" ")), F.concat(F.lit(" "), some(4, 2, " ")), F.lit('"')

    def after_text(tail):
        return F.concat(text, F.lit(tail))

    # short passwords, and short plain values
    digits, sign = F.right("number", F.lit(3)), F.substr(F.lit("!@#$%^*?"), 1 + F.col("size") % 8, F.lit(1))
    spelled = F.concat(F.initcap(F.left("w6", F.lit(5))), digits, sign, F.initcap(F.left("w7", F.lit(4))), F.left("mixed", F.lit(2)))
    leet = F.translate(F.initcap(some(6, 2, "")), "eaoi", "3401")
    leet = F.concat(F.left(leet, F.lit(11)), F.right("number", F.lit(2)))
    short, plain = F.concat(mixed(5, 8), F.right("number", F.lit(2))), F.rpad("w6", 6 + F.col("size") % 5, "er")
    payload = [F.concat(F.lit("eyJ"), F.substr(letters, F.lit(k), size(17, 12))) for k in (1, 20)]
    jwt = F.concat_ws(".", *payload, F.substr(letters, F.lit(40), F.lit(43)))
    address = F.concat(F.col("w6"), F.lit("@"), F.col("w7"), F.lit("er.com"))
    day = F.concat(F.lit("20"), F.right("number", F.lit(2)), F.lit("-11-2"), F.substr("number", F.lit(9), F.lit(1)))

    camel = F.concat(*[F.initcap(F.col(f"w{i}")) for i in range(6, 10)], F.lit("Handler"))
    kinds = [
        (after_text("password="), hexed(16, 20), close, 1),
        (after_text('token = "'), hexed(32, 32), quote, 1),
        (after_text("api_key: "), mixed(24, 16), close, 1),
        (after_text("secret="), F.left("mixed", size(32, 12)), close, 1),
        (after_text('credential: "'), F.left("mixed", size(20, 30)), quote, 1),
        (text, F.concat(F.lit("AKIA"), F.upper(mixed(16))), close, 1),
        (text, F.concat(F.lit("ghp_"), mixed(36)), close, 1),
        (after_text("Authorization: Bearer "), F.concat(F.lit("eyJ"), mixed(60, 20)), close, 1),
        (after_text("password="), spelled, close, 1),
        (after_text("password: "), leet, close, 1),
        (after_text("password is "), leet, close, 1),
        (after_text("pwd "), spelled, close, 1),
        (after_text('token: "'), spelled, quote, 1),
        (after_text("passwd="), short, close, 1),
        (after_text("secret: "), short, close, 1),
        (after_text("token "), short, close, 1),
        (after_text("https://www.host.com/v1/"), F.concat(F.lit("ghp_"), mixed(36)), close, 1),
        (after_text("path/"), F.concat(F.lit("sk-"), mixed(24, 20)), close, 1),
        (text, jwt, close, 1),
        (after_text("Authorization: Bearer "), jwt, close, 1),
        (after_text("token="), jwt, F.concat(F.lit("."), close), 1),
        (after_text("?jwt="), jwt, close, 1),
        (after_text("note: "), plain, close, 0),
        (after_text("name="), plain, close, 0),
        (after_text('name="'), plain, quote, 0),
        (after_text("pass "), plain, close, 0),
        (after_text("secret "), plain, F.concat(F.lit("."), close), 0),
        (after_text("token "), F.initcap(plain), close, 0),
        (after_text("private "), plain, F.concat(F.lit(","), close), 0),
        (after_text("password is "), plain, close, 0),
        (after_text("auth: "), plain, close, 0),
        (after_text("secret "), F.concat_ws("-", plain, "w7"), close, 0),
        (after_text("mail: "), address, close, 0),
        (after_text("private "), address, close, 0),
        (after_text("date: "), day, close, 0),
        (after_text("total="), F.right("number", F.lit(7)), close, 0),
        (after_text("id="), hexed(8, 6), close, 0),
        (after_text("name: "), leet, close, 0),
        (text, F.concat_ws(".", some(6, 4, ""), some(10, 2, ""), some(12, 4, "")), close, 0),
        (text, some(6, 5, ""), close, 0),
        (text, some(6, 7, ""), F.concat(F.lit("."), close), 0),
        (text, F.initcap(some(6, 6, "")), F.lit(","), 0),
        (text, F.upper(some(6, 6, "")), F.lit("!! "), 0),
        (text, camel, close, 0),
        (after_text("$"), some(6, 5, "_"), F.lit(" = 3"), 0),
        (text, some(6, 5, "-"), close, 0),
        (after_text("commit "), hexed(40), close, 0),
        (after_text("sha256:"), hexed(64), close, 0),
        (after_text('etag "'), hexed(32), quote, 0),
        (text, F.col("number"), close, 0),
        (text, F.left("number", F.lit(16)), close, 0),
        (after_text("order "), F.right("number", F.lit(17)), close, 0),
        (text, F.concat(F.lit("/"), some(6, 4, "/")), F.lit(".html"), 0),
        (after_text("https://www."), some(6, 5, "/"), close, 0),
        (after_text("id="), F.concat_ws("-", *[F.substr("hex", F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 12))]), close, 0),
        (F.lit(""), F.repeat(F.lit("-"), size(16, 32)), F.lit("\n"), 0),
        (F.lit(""), F.repeat(F.lit("_"), size(16, 32)), F.lit("\n"), 0),
        (F.concat(text, F.lit("postgres://"), F.col("w8"), F.lit(":")), short, F.lit("@host.com/base"), 1),
        (F.concat(text, F.lit("https://"), F.col("w8"), F.lit(":")), spelled, F.lit("@www.host.com"), 1),
        (F.concat(text, F.lit("\n")), F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\n"), mixed(64), F.lit("\n"), F.left("mixed", size(30, 20)), F.lit("\n-----END RSA PRIVATE KEY-----")), F.lit("\n"), 1),
        (F.concat(text, F.lit("-----BEGIN RSA PRIVATE ")), F.lit("KEY-----"), F.lit("\n"), 0),
        (F.concat(text, F.lit("-----BEGIN PUBLIC ")), F.lit("KEY-----"), F.lit("\n"), 0),
        (after_text("https://www.host.com/watch?v="), mixed(11), close, 0),
        (after_text('<img src="data:image/png;base64,'), F.left("mixed", size(40, 40)), quote, 0),
        (after_text('<img src="'), F.concat(F.lit("data:image/png;base64,"), F.left("mixed", size(40, 40))), quote, 0),
        (after_text('integrity="'), F.concat(F.lit("sha384-"), F.left("mixed", F.lit(64))), quote, 0),
        (after_text('title="'), F.concat(F.initcap(some(6, 2, "")), F.lit("20"), F.right("number", F.lit(2))), quote, 0),
        (after_text("name="), F.concat(F.initcap("w6"), F.right("number", F.lit(4))), close, 0),
        (after_text("http://"), F.concat(F.col("w6"), F.lit(".host.com:8080")), close, 0),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("kind"), b.alias("before"), t.alias("token"), a.alias("after"), F.lit(y).alias("is_secret")
            )
            for k, (b, t, a, y) in enumerate(kinds)
        ]
    )
    return drawn.select(F.inline(rows))


def _compiled(node, own: list[str]) -> tuple | float:
    if node.subtreeDepth() == 0:
        stats = list(node.impurityStats().stats())
        return float(stats[1] / max(sum(stats), 1e-12))
    split = node.split()
    return (
        own[split.featureIndex()],
        float(split.threshold()),
        _compiled(node.leftChild(), own),
        _compiled(node.rightChild(), own),
    )


def train(findings: DataFrame, trigrams: list[str]) -> list:
    """A forest as nested (feature, threshold, left, right) with class-1 shares as leaves.

    ``findings``: before, token, after, is_secret, a bounded list that fits one task. Rows
    with a null token or label, or tokens under three characters, do not count. With fewer
    than two labels present every candidate is a secret.
    """
    before, after = F.coalesce("before", F.lit("")), F.coalesce("after", F.lit(""))
    rows = findings.where("is_secret IS NOT NULL AND length(token) >= 3").select(
        features(before, F.col("token"), after, trigrams).alias("f"),
        F.col("is_secret").cast("double").alias("label"),
    )
    rows = rows.select("f.*", "label").coalesce(1)
    if rows.select("label").distinct().count() < 2:
        return [1.0]
    learner = RandomForestClassifier(
        featuresCol="all", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED
    )
    model = learner.fit(VectorAssembler(inputCols=FEATURES, outputCol="all").transform(rows))
    return [_compiled(tree._call_java("rootNode"), FEATURES) for tree in model.trees]


def _probability(forest: list, own: Column) -> Column:
    def expression(node):
        if isinstance(node, float):
            return F.lit(node)
        name, threshold, left, right = node
        return F.when(own[name] <= threshold, expression(left)).otherwise(expression(right))

    total = F.lit(0.0)
    for tree in forest:
        total = total + expression(tree)
    return total / len(forest)


def held_out_kinds(findings: DataFrame, trigrams: list[str], folds: int = 6) -> DataFrame:
    """(kind, is_secret, n, flagged): how many findings of each kind a forest flags that has
    seen no finding of that kind, in ``folds`` rounds over all kinds."""
    judged = []
    before, after = F.coalesce("before", F.lit("")), F.coalesce("after", F.lit(""))
    for fold in range(folds):
        held = F.col("kind") % folds == fold
        forest = train(findings.where(~held), trigrams)
        own = findings.where(held).select(
            "kind", "is_secret", features(before, F.col("token"), after, trigrams).alias("f")
        )
        flag = F.round(_probability(forest, F.col("f")), 6) >= THRESHOLD
        judged.append(own.select("kind", "is_secret", flag.alias("flag")))
    rows = judged[0]
    for more in judged[1:]:
        rows = rows.union(more)
    return rows.groupBy("kind", "is_secret").agg(
        F.count("*").alias("n"), F.count_if("flag").alias("flagged")
    )


def _scanned(docs: DataFrame, text_col: str, forest: list, trigrams: list[str]) -> DataFrame:
    """(_row, _between, _judged): the input row as a struct, the stretches between the
    candidates, and the candidates with end and score."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("_row"), text.alias("_text"))
    rows = rows.select("_row", "_text", text_spans.cut_up(F.col("_text"), CANDIDATE).alias("_parts"))
    between, found = text_spans.matches_of(F.col("_parts"), F.col("_text"), CANDIDATE)
    rows = rows.select("_row", between.alias("_between"), found.alias("_found"))
    rows = rows.select("*", text_spans.steps(F.col("_between"), F.col("_found")).alias("_steps"))
    rows = rows.select("*", text_spans.running_sums(F.col("_steps")).alias("_ends"))
    places = F.zip_with(
        F.arrays_zip(F.col("_found").alias("token"), F.col("_ends").alias("end")),
        F.arrays_zip(
            F.slice("_between", F.lit(1), F.size("_found")).alias("before"),
            F.slice("_between", F.lit(2), F.size("_found")).alias("after"),
        ),
        lambda m, b: F.struct(
            m["token"].alias("token"),
            m["end"].alias("end"),
            features(F.right(b["before"], F.lit(NEARBY)), m["token"], F.left(b["after"], F.lit(NEARBY)), trigrams).alias("f"),
        ),
    )
    rows = rows.select("_row", "_between", places.alias("_places"))
    judged = F.transform(
        "_places",
        lambda p: F.struct(
            (p["end"] - F.length(p["token"])).alias("start"),
            p["end"].alias("end"),
            F.round(_probability(forest, p["f"]), 6).alias("score"),
            p["token"].alias("token"),
        ),
    )
    return rows.select("_row", "_between", judged.alias("_judged"))


def scan(docs: DataFrame, forest: list, trigrams: list[str], text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``secrets``: array of (start, end, score) in code points,
    end exclusive, of candidates with a score of THRESHOLD. A column named ``secrets`` is
    replaced. Null and empty texts have none; repeated rows stay rows of their own."""
    rows = _scanned(docs, text_col, forest, trigrams)
    secrets = F.transform(
        F.filter("_judged", lambda j: j["score"] >= THRESHOLD),
        lambda j: F.struct(j["start"], j["end"], j["score"]),
    )
    own = [F.col("_row").getField(c).alias(c) for c in docs.columns if c != "secrets"]
    return rows.select(*own, secrets.alias("secrets"))


def redact(
    docs: DataFrame, forest: list, trigrams: list[str], text_col: str = "text", mark: str = "[secret]"
) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; texts without one stay as
    they are, nulls too."""
    rows = _scanned(docs, text_col, forest, trigrams)
    # one more stretch than matches: the last is followed by nothing
    parts = F.zip_with(
        "_between",
        "_judged",
        lambda b, j: F.concat(
            b,
            F.when(j.isNull(), F.lit(""))
            .when(j["score"] >= THRESHOLD, F.lit(mark))
            .otherwise(j["token"]),
        ),
    )
    any_secret = F.exists("_judged", lambda j: j["score"] >= THRESHOLD)
    old = F.col("_row").getField(text_col)
    new = F.when(any_secret, F.array_join(parts, "")).otherwise(old).alias(text_col)
    return rows.select(*[new if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns])


def prepared(docs: DataFrame, text_col: str = "text", findings: DataFrame | None = None) -> tuple[list, list[str]]:
    """(forest, trigrams) for ``docs``: dictionary from all their texts, forest from
    ``findings`` or from findings made by rule."""
    words = dictionary(docs, text_col)
    trigrams = trigrams_of(words)
    if findings is None:
        findings = made_findings(docs.sparkSession, words)
    return train(findings, trigrams), trigrams
