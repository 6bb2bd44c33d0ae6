"""Secret scans with a random forest that removes false positives, in DataFrame functions only.

* **Candidates** are found by one pattern over the whole text: tokens long enough to be a key that hold a
  digit, quoted values after ``=`` or ``:``, any value of six signs or more after a word for passwords and ``=``
  or ``:``, and private keys from their first line to their last. Nothing is too long to be one.
* **Features** of a candidate: its length, shares of character classes, transitions between
  classes and common letter pairs, how much of it dictionary words cover, whether it looks like a path,
  address or number, and the words beside it.
* **Forest.** Spark ML fits it on labelled findings: by default ``FINDINGS`` rows made by rule
  (``labelled_findings``), or a table of (value, before, after, label) of the caller's. The fitted
  trees become one SQL expression, so scanning is a projection: no shuffle, no join, no Python.

Edge cases: a null text has no candidates and stays null; texts are scanned whole; repeated rows are
rows; an empty table gives no rows. The columns of the input may have any name.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import free_prefix, kept

FINDINGS = 6000
TREES = 20
DEPTH = 7
SEED = 11
#: Characters beside a candidate that its features may look at.
BEFORE, AFTER = 64, 16
REDACTED = "[SECRET]"

TOKEN = r"[A-Za-z0-9+/_.\-]"
#: A token with a digit. '=' parts a name from its value and belongs to a token as its padding only.
KEY = rf"(?=[A-Za-z+/_.\-]*+[0-9]){TOKEN}{{16,}}+(?:={{1,3}}+(?![\"'`]?{TOKEN}))?+"
PEM = r"-----BEGIN ([A-Z0-9 ]{0,30})PRIVATE KEY((?: BLOCK)?)-----"
#: What follows the first line of a private key: a new line (also a written one), or the key or its
#: headers on the same line. A first line within running text is a candidate by itself.
KEY_FOLLOWS = (
    r"(?=[ \t\"'`,+]*+(?:[\r\n]|\\+[nr]|<br|[A-Za-z0-9+/=]{16}"
    r"|(?:Version|Comment|Hash|Charset|MessageID|Proc-Type|DEK-Info):))"
)
CANDIDATE = (
    # to its last line, or to the end of the text
    rf"{PEM}(?:{KEY_FOLLOWS}(?s:.*?)(?:-----END \1PRIVATE KEY\2-----|\z))?+"
    rf"|(?<!{TOKEN}){KEY}"
    # a quoted value that holds no such key after a '='
    rf"|(?<=[=:] ?[\"'])(?![^\"'\s]*={KEY})[^\"'\s]{{8,}}+(?=[\"'])"
    # any value right after a word for passwords, also one without digits
    r"|(?<=[=:][ \t]?)(?<=(?i:passw(?:or)?d|passphrase|pwd|pass|secret|token|api_?key)[\"'`]?[ \t]?[=:][ \t]?)"
    r"(?:[^\s\"'`<>&;,]|&(?!\w+=)){6,}+"
)

# Words that tell secrets from what looks like them.
SECRET_WORDS = (
    "token secret password passwd passphrase pwd pass key apikey auth authorization bearer credential "
    "credentials private access"
).split()
HARMLESS_WORDS = (
    "commit sha sha1 sha256 md5 checksum hash digest etag uuid guid id order invoice phone tel card "
    "account isbn version release build rev revision ref number image example sample dummy test "
    "placeholder"
).split()
DICTIONARY = (
    "about access account admin after again all and any api apple auth back base because been before "
    "build change client code com config core data date day default demo dev document domain dummy "
    "edit email error example feed file first form from get good group have help here home host html "
    "http image index info into item key lang last lib life like list local login mail main make "
    "many master media member menu more name net new news number once only open order other over page "
    "part pass password people photo place placeholder post product public query read release report "
    "sample search secret section server service session set shop show site some source start "
    "static store string style system table target temp test text that the their them then there these "
    "thing this time title token tool type under update upload url use user utm value version video "
    "view was web week well were what when where which while will with word work would www year your "
    "changeme insert redacted"
).split()
PAIRS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le".split()
PREFIXES = "AKIA ASIA ghp_ gho_ ghs_ glpat- sk_live_ sk- rk_live_ xoxb- xoxp- AIza eyJ".split()
NAMES = (
    "length digits upper lower other changes distinct pairs covered path numeric hexadecimal uuid "
    "address run prefix secret_word harmless_word assigned quoted pem"
).split()


def features(value: Column, before: Column, after: Column) -> Column:
    """A struct of doubles, one for each of ``NAMES``. A private key is judged by its first line."""
    value = F.when(value.startswith("-----BEGIN"), F.regexp_extract(value, PEM, 0)).otherwise(value)
    n = F.length(value).cast("double")
    count = lambda pattern: F.regexp_count(value, F.lit(pattern)).cast("double")
    flag = lambda condition: condition.cast("double")
    shape = value
    for pattern, letter in ((r"[a-z]", "a"), (r"[A-Z]", "B"), (r"[0-9]", "9"), (r"[^aB9]", ".")):
        shape = F.regexp_replace(shape, pattern, letter)
    kinds = "aB9."
    changes = "|".join(f"{a}(?=[{kinds.replace(a, '')}])" for a in ("a", "B", "9", r"\."))
    changes = changes.replace(r"[aB9.]", "[aB9]")
    near = F.lower(before)
    beside = lambda words: flag(
        near.rlike(rf"(?:^|[^a-z])(?:{'|'.join(words)})(?:[^a-z]+[a-z]+){{0,1}}[^a-z]*$")
    )
    covered = F.regexp_replace(F.lower(value), "|".join(sorted(DICTIONARY, key=len)[::-1]), "")
    found = {
        "length": F.least(n, F.lit(200.0)),
        "digits": count("[0-9]") / n,
        "upper": count("[A-Z]") / n,
        "lower": count("[a-z]") / n,
        "other": count("[^A-Za-z0-9]") / n,
        "changes": F.regexp_count(shape, F.lit(changes)).cast("double") / n,
        "distinct": F.size(F.array_distinct(F.split(F.lower(value), ""))).cast("double")
        / F.least(n, F.lit(36.0)),
        "pairs": F.regexp_count(F.lower(value), F.lit(f"(?={'|'.join(PAIRS)})")).cast("double") / n,
        "covered": 1 - F.length(covered).cast("double") / n,
        "path": flag(
            value.rlike(r"^/|^\.{0,2}/|(?:/[A-Za-z0-9_.\-]+){2}|\.[a-z]{2,4}(?:$|/)")
            | before.rlike(r"(?:[/\\~]|://)$")
        ),
        "numeric": flag(value.rlike(r"^[0-9+.\-/=_]+$")),
        "hexadecimal": flag(value.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "uuid": flag(value.rlike(r"^[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$")),
        "address": flag(
            before.rlike("@$|://$")
            | after.rlike("^@")
            | value.rlike(r"(?i)^(?:[a-z0-9\-]+\.)+(?:com|org|net|io|de|fr|es|example)\b")
        ),
        "run": flag(value.rlike(r"(.)\1{3}")),
        "prefix": flag(value.rlike(rf"^(?:{'|'.join(re.escape(p) for p in PREFIXES)})")),
        "secret_word": beside(SECRET_WORDS),
        "harmless_word": beside(HARMLESS_WORDS),
        "assigned": flag(before.rlike(r"[=:>][^\p{L}\p{N}]{0,6}$")),
        "quoted": flag(before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]")),
        "pem": flag(value.startswith("-----BEGIN")),
    }
    return F.struct(*[F.coalesce(found[k], F.lit(0.0)).alias(k) for k in NAMES])


def labelled_findings(
    spark: SparkSession, n: int = FINDINGS, without: tuple[str, ...] = ()
) -> DataFrame:
    """(value, before, after, label, kind) made by rule: half secrets, half what only looks like them.

    As many texts are made of each kind of secret, and as many of each kind of lookalike; the rows are
    what a scan finds in them. A text holds one candidate at most. Words and marks around the values are
    common ones and come from no table. ``without`` leaves kinds out, to hold them out of a fit.
    """
    h = lambda salt: F.xxhash64("id", F.lit(salt))

    def pick(of: list[str], salt: str) -> Column:
        at = F.pmod(h(salt), F.lit(len(of))) + 1
        return F.element_at(F.array(*[F.lit(x) for x in of]), at.cast("int"))

    def cut(x: Column, size: int | Column, begin: int | Column = 1) -> Column:
        return F.substring(x, begin, size)

    def size(low: int, high: int, salt: str) -> Column:
        return (F.pmod(h(salt), F.lit(high - low + 1)) + low).cast("int")

    digest = F.sha2(F.concat(F.lit("finding "), F.col("id").cast("string")), 512)
    mixed = F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", "")
    number = F.regexp_replace(digest, "[^0-9]", "")
    upper = F.upper(F.regexp_replace(mixed, "[^A-Z0-9]", ""))
    uuid = F.concat_ws("-", *[cut(digest, k, a) for a, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    prose = (
        "the a of and to in is it for on with as at by we you they this that see use get made new old "
        "one two part line der die das und la le les de que y el un une para mit"
    ).split()
    names = "report image archive chart notes photo index summary".split()
    no_text = F.lit("")
    said = F.concat_ws(" ", pick(prose, "w1"), pick(prose, "w2"), no_text)
    near = F.concat_ws(" ", pick(prose, "w1"), pick(prose, "w2"), pick(prose, "w3"), no_text)
    # Marks of any kind may follow a word: none mostly, or one repeated up to three times.
    mark = F.repeat(pick(list("!#*%~+.,;)"), "mark"), size(1, 3, "marks"))
    tail = F.when(F.pmod(h("tail"), F.lit(2)) == 0, no_text).otherwise(mark)
    words = [*SECRET_WORDS, "api_key", "auth_token", "client_secret"]
    asked = pick([f(w) for w in words for f in (str.lower, str.upper, str.title)], "word")
    sign = pick([" = ", "=", ": ", " : ", " => ", " ", " is "], "sign")
    quote = pick(['"', '"', '"', "'", ""], "quote")
    assigned = F.concat(said, asked, tail, sign, F.when(F.pmod(h("odd"), F.lit(6)) == 0, mark).otherwise(no_text), quote)
    # settings and links: no quotes, and the sign right after the name
    name = F.concat(pick(["", "", "AWS_", "app_", "MY_", "db."], "whose"), asked)
    link = F.concat(F.lit("https://"), pick(["api", "www"], "site"), F.lit(".example.com/a?"))
    bare = F.concat(pick(["", "\n", "export ", "&", "?"], "stands"), name, F.lit("="))
    link = F.concat(pick(["", "", 'href="'], "href"), link, pick(["", "page=2&"], "page"))
    bare = F.when(F.pmod(h("linked"), F.lit(3)) == 0, F.concat(link, name, F.lit("="))).otherwise(bare)
    ends = pick(["", "\n", "&page=2", ";", '">', "'>"], "ends")
    setting = F.concat_ws(
        "_", pick(["AWS_S3", "APP2_PROD", "DB_1_MAIN", "MY_K8S"], "v1"), F.upper(pick(words, "v2")), F.lit("KEY"), cut(number, 1)
    )
    labelled = F.concat(said, pick(HARMLESS_WORDS, "of"), pick([" ", ": ", " = ", "="], "to"), quote)
    phrase = pick("password passwd passphrase pwd pass secret token api_key".split(), "phrase")
    phrase = F.when(F.pmod(h("up"), F.lit(3)) == 0, F.upper(phrase)).otherwise(phrase)
    to = pick([": ", "=", " = ", ":"], "colon")
    # a password beside its word, with and without quotes
    login = F.concat(pick(["", "my ", "db_", "the "], "my"), phrase, to, quote)
    path = F.concat(
        F.lit("/"), pick(names, "p1"), F.lit("/"), pick(names, "p2"), cut(number, 3), F.lit(".txt")
    )
    host = F.concat(
        pick(["mail", "www", "cdn"], "host"), cut(number, 1), pick([".example.com", ".example.org"], "top")
    )
    placeholders = (
        "xxxxxxxxxxxxxxxxxxx1 your_token_here_123 example-password-1234 0000000000000000 "
        "changeme12345678 insert-api-key-here-1 test_token_12345678 dummy_secret_value_1"
    ).split()
    # what stands after such a word in texts and programs and is no secret
    spoken = (
        "required optional missing changed expired invalid disabled everyone something nothing string "
        "number boolean undefined default... process.env.TOKEN getToken() ${PASSWORD} os.environ None,None "
        "forgotten characters needed. protected unknown because {{secret}} %(token)s self.token"
    ).split()
    long_words = [w for w in DICTIONARY if len(w) > 3 and w not in ("changeme", "redacted", "placeholder")]
    long_words += "river stone tiger copper window silver garden monkey dragon summer bridge kettle marble".split() * 6
    prefixed = {
        "aws": F.concat(F.lit("AKIA"), cut(upper, 16)),
        "github": F.concat(pick(["ghp_", "gho_", "ghs_"], "gh"), cut(mixed, 36)),
        "stripe": F.concat(pick(["sk_live_", "rk_live_"], "sk"), cut(mixed, 24)),
        "slack": F.concat(pick(["xoxb-", "xoxp-"], "xo"), cut(number, 11), F.lit("-"), cut(mixed, 24)),
        "gitlab": F.concat(F.lit("glpat-"), cut(mixed, 20)),
        "google": F.concat(F.lit("AIza"), cut(mixed, 35)),
        "jwt": F.concat(F.lit("eyJ"), cut(mixed, 30), F.lit("."), cut(mixed, 40, 31)),
    }
    plain = {
        "hex32": cut(digest, 32),
        "hex40": cut(digest, 40),
        "hex64": cut(digest, 64),
        "HEX40": F.upper(cut(digest, 40)),
        "mixed20": cut(mixed, 20),
        "mixed32": cut(mixed, 32),
        "mixed40": cut(mixed, 40),
        "long": F.concat(mixed, cut(digest, size(100, 128, "rest")), F.reverse(mixed)),
    }
    passwords = {
        "word and digits": F.concat(
            pick(long_words, "x1"), cut(number, size(1, 4, "d")), pick(list("!@#$%*?"), "x2")
        ),
        "random": F.concat(cut(mixed, size(6, 12, "r")), pick(list("!@#$%*?"), "x3"), cut(number, 1, 5)),
        "words": F.concat(
            pick(long_words, "y1"), pick(long_words, "y2"), pick(long_words, "y3"), pick(long_words, "y4")
        ),
    }
    kind = pick(["RSA ", "EC ", "DSA ", "OPENSSH ", "ENCRYPTED ", "", "PGP "], "kind")
    block = F.when(kind == "PGP ", F.lit(" BLOCK")).otherwise(no_text)
    edge = lambda x: F.concat(F.lit(f"-----{x} "), kind, F.lit("PRIVATE KEY"), block, F.lit("-----"))
    pem = F.concat(edge("BEGIN"), F.lit("\n"), mixed, F.lit("\n"), cut(mixed, 30), F.lit("\n"), edge("END"))
    # what stands before the value, the value, what stands after it
    lookalikes = {
        "commit": (labelled, cut(digest, 40), quote),
        "checksum": (labelled, cut(digest, 64), quote),
        "uuid": (labelled, uuid, quote),
        "linked id": (F.concat(link, pick(HARMLESS_WORDS, "of"), F.lit("=")), cut(digest, 40), ends),
        "placeholder set": (bare, pick(placeholders, "placeholder"), ends),
        "number": (labelled, cut(number, 16), quote),
        "placeholder": (assigned, pick(placeholders, "placeholder"), quote),
        "number in prose": (near, cut(number, 16), tail),
        "path": (near, path, tail),
        "url": (F.concat(near, F.lit("http://")), F.concat(host, path), no_text),
        "mail": (F.concat(near, pick(prose, "m"), F.lit(".7@")), host, tail),
        "slug": (near, F.concat_ws("-", pick(names, "a"), pick(names, "b"), cut(number, 2)), tail),
        "uuid in prose": (near, uuid, tail),
        "phone": (near, F.concat(F.lit("+1-"), cut(number, 3), F.lit("-555-"), cut(number, 4, 4)), tail),
        "file": (near, F.concat(pick(names, "a"), pick(names, "b"), pick(names, "c"), cut(number, 2)), tail),
        "release": (near, F.concat(F.lit("2024-0"), cut(number, 1), F.lit("-release-"), cut(number, 4, 2)), tail),
        "digest in prose": (near, cut(digest, 40), tail),
        "setting": (pick(["", "export ", "set "], "v3"), setting, F.concat(F.lit("="), quote, F.lit("x1"), quote)),
        "spoken": (F.concat(pick(["", "my ", "the "], "my"), phrase, to), pick(spoken, "spoken"), F.lit(" ")),
        "spoken quoted": (F.concat(phrase, to, F.lit('"')), pick(spoken, "spoken"), F.lit('"')),
    }
    cases = [(k, assigned, x, F.concat(quote, tail), 1.0) for k, x in (plain | prefixed).items()]
    cases += [(f"{k} set", bare, x, ends, 1.0) for k, x in (plain | prefixed).items()]
    cases += [(f"{k} in prose", near, x, tail, 1.0) for k, x in prefixed.items()]
    cases += [(k, login, x, F.concat(quote, F.lit(" ")), 1.0) for k, x in passwords.items()]
    cases += [
        (k, x, pem, F.lit("\n"), 1.0)
        for k, x in (("key named", assigned), ("key below", F.concat(near, F.lit("\n"))), ("key alone", no_text))
    ]
    cases += [("first line", near, edge("BEGIN"), F.lit(" "), 1.0)]
    cases += [(k, *x, 0.0) for k, x in lookalikes.items()]
    made = None
    for i, (of, before, value, after, label) in enumerate(cases):
        if of in without:
            continue
        each = n // 2 // (len(cases) - len(lookalikes) if label else len(lookalikes))
        rows = spark.range(i * n, i * n + each, 1, 1).select(
            F.concat(before, value, F.concat_ws(" ", after, pick(prose, "w4"))).alias("text"),
            F.lit(label).alias("label"),
            F.lit(of).alias("kind"),
        )
        made = rows if made is None else made.unionByName(rows)
    pieces = cut_out(made, "text")
    values, parts = F.col("values"), F.col("parts")

    def shown(v: Column, i: Column) -> Column:
        before, after = beside(values, parts, i)
        return F.struct(v.alias("value"), before.alias("before"), after.alias("after"))

    return pieces.select(F.inline(F.transform(values, shown)), "label", "kind")


def fit(findings: DataFrame) -> list[str]:
    """The fitted trees as SQL expressions over a struct ``f``; each is 1 for a secret.

    Fits a bounded table of findings; all rows of it are used.
    """
    findings = kept(findings.select("value", "before", "after", "label").coalesce(1))
    described = features(F.col("value"), F.col("before"), F.col("after"))
    rows = kept(findings.select(described.alias("f"), "label").select("f.*", "label"))
    model = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        featureSubsetStrategy="sqrt",
    ).fit(VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows))
    return trees_as_sql(model.toDebugString)


def trees_as_sql(shown: str) -> list[str]:
    """SQL for each tree of a forest's printed form."""
    lines = [x.strip() for x in shown.splitlines() if x.strip()]
    at = 0

    def node() -> str:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            return str(int(float(line.split(":")[1])))
        m = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
        if m is None:
            raise ValueError(f"unexpected line of a tree: {line}")
        yes = node()
        at += 1  # Else
        no = node()
        return f"IF(c.f.{NAMES[int(m[1])]} <= {float(m[2])!r}D, {yes}, {no})"

    out = []
    while at < len(lines):
        is_tree = lines[at].startswith("Tree ")
        at += 1
        if is_tree:
            out.append(node())
    return out


def trained(spark: SparkSession, findings: DataFrame | None = None) -> list[str]:
    return fit(labelled_findings(spark) if findings is None else findings)


def cut_out(docs: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """``docs`` with ``values``, the candidates of a text, and ``parts``, the text between them."""
    body = F.col(text)
    has = F.coalesce(body.rlike(CANDIDATE), F.lit(False))
    return docs.select(
        *[F.col(c) for c in docs.columns],
        F.when(has, F.split(body, CANDIDATE)).otherwise(F.array(body)).alias(f"{prefix}parts"),
        F.when(has, F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)))
        .otherwise(F.array().cast("array<string>"))
        .alias(f"{prefix}values"),
    )


def beside(values: Column, parts: Column, i: Column) -> tuple[Column, Column]:
    """What stands before and after candidate ``i``."""
    or_empty = lambda x: F.coalesce(x, F.lit(""))
    before = F.concat(or_empty(F.get(values, i - 1)), or_empty(F.get(parts, i)))
    after = F.concat(or_empty(F.get(parts, i + 1)), or_empty(F.get(values, i + 1)))
    return F.right(before, F.lit(BEFORE)), F.left(after, F.lit(AFTER))


def found(docs: DataFrame, trees: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``parts`` (the text between candidates) and ``candidates``: value, score, secret.

    A candidate's score is the share of trees that call it a secret.
    """
    p = prefix
    keep = [F.col(c) for c in docs.columns]
    out = cut_out(docs, text, p)
    values, parts = F.col(f"{p}values"), F.col(f"{p}parts")

    def described(v: Column, i: Column) -> Column:
        return F.struct(v.alias("value"), features(v, *beside(values, parts, i)).alias("f"))

    out = out.select(
        *keep,
        parts,
        F.when(F.size(values) > 0, F.transform(values, described)).alias(f"{p}described"),
    )
    score = f"({' + '.join(trees)}) / {float(len(trees))}D"
    scored = F.expr(
        f"transform(`{p}described`, c -> named_struct('value', c.value, 'score', {score}))"
    )
    out = out.select(*keep, parts, scored.alias(f"{p}scored"))
    judged = F.transform(
        f"{p}scored",
        lambda c: F.struct(
            c["value"].alias("value"),
            F.round(c["score"], 4).alias("score"),
            (c["score"] >= 0.5).alias("secret"),
        ),
    )
    return out.select(
        *keep,
        parts,
        F.coalesce(judged, F.array().cast("array<struct<value:string,score:double,secret:boolean>>"))
        .alias(f"{p}candidates"),
    )


def redacted(p: str = "") -> Column:
    """The text with secrets replaced; other text is kept to the character."""
    candidates = F.col(f"{p}candidates")

    def joined(part: Column, i: Column) -> Column:
        c = F.get(candidates, i)
        value = F.when(c["secret"], F.lit(REDACTED)).otherwise(c["value"])
        return F.concat(part, F.coalesce(value, F.lit("")))

    parts = F.col(f"{p}parts")
    joined_text = F.array_join(F.transform(parts, joined), "")
    return F.when(F.exists(parts, lambda x: x.isNotNull()), joined_text)


def spans(p: str = "") -> Column:
    """Start (in characters, from 0), length and score of each secret."""
    candidates, parts = F.col(f"{p}candidates"), F.col(f"{p}parts")
    nothing = F.array().cast("array<struct<start:int,length:int,score:double>>")

    def add(acc: Column, i: Column) -> Column:
        c = F.get(candidates, i)
        start = acc["at"] + F.length(F.get(parts, i))
        span = F.struct(
            start.alias("start"), F.length(c["value"]).alias("length"), c["score"].alias("score")
        )
        return F.struct(
            (start + F.length(c["value"])).alias("at"),
            F.when(c["secret"], F.concat(acc["spans"], F.array(span)))
            .otherwise(acc["spans"])
            .alias("spans"),
        )

    every = F.sequence(F.lit(0), F.size(candidates) - 1)
    walked = F.aggregate(
        every, F.struct(F.lit(0).alias("at"), nothing.alias("spans")), add, lambda acc: acc["spans"]
    )
    any_secret = F.exists(candidates, lambda c: c["secret"])
    return F.when(any_secret, walked).otherwise(nothing)


def scan(docs: DataFrame, trees: list[str], id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its candidates, secrets, where they are, and the digest of the redacted text."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    return found(rows, trees).select(
        "doc_id",
        F.size("candidates").cast("long").alias("n_candidates"),
        F.size(F.filter("candidates", lambda c: c["secret"])).cast("long").alias("n_secrets"),
        spans().alias("spans"),
        F.sha2(F.encode(redacted(), "UTF-8"), 256).alias("redacted_sha256"),
    )


def redact(docs: DataFrame, trees: list[str], text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` in their own columns, with secrets replaced and lengths put right."""
    p = free_prefix(docs.columns)
    rows = found(docs, trees, text, p).withColumn(f"{p}redacted", redacted(p))
    return rows.select(
        *[
            F.col(f"{p}redacted").alias(c)
            if c == text
            else F.length(f"{p}redacted").cast(docs.schema[c].dataType).alias(c)
            if c == n_chars
            else F.col(c)
            for c in docs.columns
        ]
    )
