"""Secrets in texts: candidates by shape, false findings removed by a random forest.

All of the scan is SQL on strings and arrays. A candidate is a private key in its
armour, a signed token of three dotted parts, the password of an address, a value of
six characters or more behind a secret's name, or a long run of token characters with a
digit or mixed case. What names a value (``NAME=``, ``password: "``) is parted from it and
belongs to the text on its left. Features of a value are its length, character classes
and transitions, how much of it dictionary words cover, path shape, and the words beside
it in the whole text. They are written once, for three dialects: Spark, DuckDB (the
oracle) and Python, in which the forest is trained on candidates scanned from a bounded
number of labelled lines that a seeded rule makes.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable
from functools import lru_cache
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.storage import apart

_BLANK = r" \t\r\n"
_NAMES = "(?i:passw(?:or)?d|passphrase|pwd|secret|token|credential|api[_-]?key|access[_-]?key|auth)"
#: What stands before a value: the user of an address, a secret's name, or any name with an equals sign.
_LOGIN = f"[a-z][a-z0-9+.-]{{0,10}}://[^/:@{_BLANK}]{{1,64}}:"
_NAMED = f"[A-Za-z0-9_.-]{{0,40}}{_NAMES}[A-Za-z0-9_]{{0,20}}[\"']?[ ]?[:=][ ]?[\"']?"
_VALUE = f"[^{_BLANK}\"'<>,;]{{6,}}"
RUN = "[A-Za-z0-9+/_=-]{16,}"
CANDIDATE = "|".join(
    [
        "-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*-----END [A-Z ]*PRIVATE KEY-----", "eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]*",
        f"{_LOGIN}[^/@{_BLANK}]{{1,64}}@", f"{_NAMED}{_VALUE}", RUN,
    ]
)
#: Without one of these in a text, its candidates are its RUNs, which are found much faster.
HINT = f"{_NAMES}[A-Za-z0-9_]{{0,20}}[\"']?[ ]?[:=]|://[^/:@{_BLANK}]{{1,64}}:|-----BEGIN|eyJ"
PREFIX = f"^({_LOGIN}|{_NAMED}|[A-Za-z][A-Za-z0-9_]{{0,40}}=)[^=]"
MIXED = "[0-9]|[a-z][A-Z].*[a-z][A-Z]|^-----BEGIN"
LEFT, RIGHT = 40, 16
#: Candidates, of 8 characters or more, that reach LEFT and RIGHT.
BACK, AHEAD = 5, 2
MASK = "[SECRET]"

FINDINGS, TREES, DEPTH, LEAST_LEAF, SEED = 5000, 15, 7, 5, 11
#: Leaves hold shares in thousandths; so sums are whole numbers in every dialect.
SHARE = 1000

# Frequent words and parts of words of English and of code, of four letters or more.
DICTIONARY = (
    "about above access account action after again area array assert back base before begin block body book build byte cache call case cast change char check child class clear "
    "client close code color column common config connect const content context control copy count create current data date debug default delete device document down draw each edit "
    "element else email empty enable entry error event example exit export false field file filter final find first float folder font form format from function general group handle "
    "have head height help high home host html http icon image import index info init input insert inter item java keep kind large last layout left length level library light like line "
    "link list load local lock main make manager master match method model module more name need network next node note null number object offset open option order other output over "
    "package page panel parent part path plain play point port post print process project property public query queue quick random range read record remove report request resource "
    "result return right root rule same sample save scale screen script search section select send server service session shape show side simple size some sort source space start state "
    "static status step stop store stream string style system table target task template test text that then this thread time title tool total true type under unit update upload user "
    "using util value vector version view visible when where which while width window with word work world write"
).split()

WORDS_FOR = "(token|secret|passw|pwd|api|key|auth|bearer|credential)[^a-z]{0,12}$"
WORDS_AGAINST = "(sha|md5|commit|checksum|digest|uuid|hash|etag|example|sample|dummy|build|rev|isbn|order|phone|card)[^ ]{0,8}[^a-z]{0,8}$"


class Spark:
    """Expressions as Spark SQL text."""

    @staticmethod
    def text(x: str) -> str:
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"

    length = staticmethod(lambda x: f"length({x})")
    lower = staticmethod(lambda x: f"lower({x})")
    minus = staticmethod(lambda a, b: f"({a} - {b})")

    @classmethod
    def without(cls, x: str, pattern: str) -> str:
        return f"regexp_replace({x}, {cls.text(pattern)}, '')"

    @classmethod
    def has(cls, x: str, pattern: str) -> str:
        return f"CAST({x} RLIKE {cls.text(pattern)} AS INT)"

    @classmethod
    def prefix(cls, x: str) -> str:
        return f"regexp_extract({x}, {cls.text(PREFIX)}, 1)"


class Duck(Spark):
    @staticmethod
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    @classmethod
    def without(cls, x: str, pattern: str) -> str:
        return f"regexp_replace({x}, {cls.text(pattern)}, '', 'g')"

    @classmethod
    def has(cls, x: str, pattern: str) -> str:
        return f"CAST(regexp_matches({x}, {cls.text(pattern)}) AS INT)"


class Plain:
    """The same, worked out at once."""

    length, lower = staticmethod(len), staticmethod(str.lower)
    minus = staticmethod(lambda a, b: a - b)
    without = staticmethod(lambda x, pattern: re.sub(pattern, "", x))
    has = staticmethod(lambda x, pattern: int(re.search(pattern, x) is not None))


def features(o: Any, c: Any, left: Any, right: Any) -> list[Any]:
    """Of a value and what stands beside it, on one line."""
    count = lambda x, pattern: o.minus(o.length(x), o.length(o.without(x, pattern)))
    low, near = o.lower(c), o.lower(left)
    return [
        o.length(c), count(c, "[0-9]"), count(c, "[A-Z]"), count(c, "[a-z]"), o.has(c, "^([0-9a-f]+|[0-9A-F]+)$"), o.has(c, "^[0-9_=+/-]+$"),
        count(c, "[A-Za-z][0-9]"), count(c, "[0-9][A-Za-z]"), count(c, "[a-z][A-Z]"), count(low, "[aeiou][^aeiou0-9+/_=-]"), o.has(c, "[A-Za-z]{8}"),
        count(low, "(" + "|".join(DICTIONARY) + ")"), count(c, "/"), count(c, "[_-]"), o.has(c, "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-"), o.has(c, "^(AKIA|gh[pousr]_|xox[bap]-|sk_|eyJ|-----BEGIN)"),
        o.has(near, WORDS_FOR), o.has(left, "[:=] *[\"']?$"), o.has(right, "^[\"']"), o.has(near, WORDS_AGAINST), o.has(near, "(https?:/?/?|www[.])[^ ]*$"), o.has(right, "^[@.]"), o.has(left, "[@.]$"), o.has(c, "^/|^[a-z]+/"),
        count(c, "[^A-Za-z0-9+/_=-]"), o.has(c, "[(){}\\[\\]$]|[.][a-z]"), o.has(left, "://[^ ]*:$"),
    ]


def _line(rng: random.Random) -> tuple[str, str, str, int]:
    """(left, value, right, whether it is a secret), by rule."""
    digits, hexa = "0123456789", "0123456789abcdef"
    letters = "abcdefghijklmnopqrstuvwxyz"
    base = letters + letters.upper() + digits
    draw = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    word = lambda: rng.choice(DICTIONARY) if rng.random() < 0.4 else draw("aeiou" + letters, rng.randint(2, 8))
    before = " ".join(word() for _ in range(rng.randint(0, 5)))
    quote = rng.choice(["", '"', "'"])
    sign = rng.choice([" = ", "=", ": ", ":"])
    case = rng.choice([str, str, str.upper, str.title])
    name = case(rng.choice(["token", "api_key", "apikey", "secret", "client_secret", "password", "passwd", "auth_token", "access_key", "credentials", "authorization", "github_token", "aws_secret_access_key", "db_password"]))
    after = f"{quote}{rng.choice(['', ' ', ',', ';', '###', '!!']) if quote else rng.choice(['', ' '])}"
    if rng.random() < 0.5:
        kind = rng.random()
        if kind < 0.05:
            body = "\n".join(draw(base + "+/", 64) for _ in range(rng.randint(3, 12)))
            return f"{before}\n", f"-----BEGIN {rng.choice(['', 'RSA ', 'EC '])}PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----", "\n", 1
        if kind < 0.1:
            return f"{before} {rng.choice(['postgres', 'https', 'ftp', 'mongodb+srv', 'amqp'])}://{word()}:", draw(base + "!$%^*-_", rng.randint(5, 20)), f"@{word()}.{rng.choice(['com', 'net'])}/", 1
        if kind < 0.16:
            return f"{before} {rng.choice(['Bearer ', '', 'jwt '])}", "eyJ" + ".".join(draw(base + "_-", rng.randint(20, 80)) for _ in range(3)), " ", 1
        if kind < 0.3:
            return f"{before} {name}{sign}{quote}", draw(letters, rng.randint(2, 6)) + draw(digits + "!@#$%^&*_-", rng.randint(2, 4)) + draw(base + "!@#$%^&*_-", rng.randint(2, 8)), after, 1
        value = rng.choice(
            [draw(hexa, rng.choice([32, 40, 40, 48, 64])), draw(base, rng.randint(20, 60)), draw(base + "+/", rng.randint(24, 64)) + "=", "AKIA" + draw(letters.upper() + digits, 16), "ghp_" + draw(base, 36), "sk_live_" + draw(base, 24), "eyJ" + draw(base + "_-", 60)]
        )
        if rng.random() < 0.1 and value[:4] in ("AKIA", "ghp_", "sk_l"):
            return before + rng.choice([" ", " GH=", " export KEY="]), value, rng.choice([" ", ".", ""]), 1
        if rng.random() < 0.2:
            value = value.upper() if set(value) <= set(hexa) else value
        return f"{before} {name}{rng.choice([sign, ' '])}{quote}", value, after, 1
    kind = rng.randrange(12)
    if kind == 0:
        return f"{before} {case(rng.choice(['commit', 'sha1', 'sha256', 'md5', 'checksum', 'digest', 'rev', 'etag', 'build']))}{sign}{quote}", draw(hexa, rng.choice([32, 40, 64])), quote, 0
    if kind == 1:
        return f"{before}{rng.choice([' ', ' uuid ', ' id: '])}", "-".join(draw(hexa, n) for n in (8, 4, 4, 4, 12)), " ", 0
    if kind == 2:
        return f"{before}{rng.choice([' ', ' see ', ' in '])}", "/" * rng.randint(0, 1) + "/".join(word() + draw(digits, rng.randint(0, 2)) for _ in range(rng.randint(3, 7))), rng.choice([".py", " ", ".html"]), 0
    if kind == 3:
        return f"{before}{rng.choice([' ', ' card ', ' no. ', ' phone +'])}", draw(digits, rng.choice([16, 16, 18, 20])), " ", 0
    if kind == 4:
        return f"{before} https:", "//" + draw(letters, 9) + "/" + word() + "/" + draw(base, rng.randint(4, 12)), rng.choice([" ", ".html", "?"]), 0
    if kind == 5:
        return f"{before} ", rng.choice("_-").join(word() for _ in range(rng.randint(3, 6))) + draw(digits, rng.randint(1, 4)), " ", 0
    if kind == 6:
        return f"{before} ", "".join(word().title() for _ in range(rng.randint(3, 6))), rng.choice(["(", " ", "."]), 0
    if kind == 7:
        return f"{before} {rng.choice(['example', 'sample', 'dummy'])} {rng.choice(['token', 'key', 'secret'])} ", rng.choice(["0123456789abcdef", "1234567890123456", "xxxxxxxxxxxxxxxx1", "aaaaaaaa00000000"]) * rng.randint(1, 2), " ", 0
    if kind in (8, 9):  # a name, but what follows is prose or code
        prose = rng.choice([word() + word(), word() + word() + rng.choice([".", "?", "!"]), "required", "optional", "missing", "invalid", "redacted", "something", "******", "xxxxxxxx"])
        code = rng.choice([f"os.environ[{word()}]", f"get_{word()}()", f"self.{word()}_{word()}", f"${{{word()}_{word()}}}", f"{word()}.{word()}.{word()}", "{{ " + word(), f"{word()}({word()})", "None", f"request.{word()}"])
        return f"{before} {name}{sign}{quote}", prose if rng.random() < 0.5 else code, after, 0
    if kind == 10:
        return f"{before} {rng.choice(['version', 'width', 'lang', 'path', 'mode', 'title'])}=", rng.choice([word() + word() + word() + draw(digits, 2), draw(digits, 14), "/" + word() + "/" + word() + "/" + word()]), " ", 0
    return f"{before} ", "-".join(draw(digits, n) for n in (4, 2, 2)) + "_" + draw(digits, 6) + rng.choice(["", "_" + word()]), rng.choice([" ", ".log", ".txt"]), 0


def candidates(text: str) -> list[tuple[str, str, str, int]]:
    """(value, left, right, its place in the text) of each candidate of a text, in Python."""
    out = []
    for m in re.finditer(CANDIDATE, text):
        known = re.match(PREFIX, m[0])
        at = m.start() + (known.end(1) if known else 0)
        value = re.sub("@$", "", text[at : m.end()]) if known and "://" in known[1] else text[at : m.end()]
        if known or re.search(MIXED, value):
            out.append((value, _flat(text[:at][-LEFT:]), _flat(text[at + len(value) :][:RIGHT]), at))
    return out


def _flat(x: str) -> str:
    return x.replace("\n", " ").replace("\r", " ")


def labelled(lines: int, seed: int) -> list[tuple[list[float], int]]:
    """Features and label of every candidate that is scanned from ``lines`` made lines."""
    rng, out = random.Random(seed), []
    for _ in range(lines):
        left, value, right, y = _line(rng)
        for found, near, after, at in candidates(left + value + right):
            own = at < len(left) + len(value) and at + len(found) > len(left)
            out.append((features(Plain, found, near, after), y if own else 0))
    return out


Tree = tuple[int, float, Any, Any] | int


def _grow(rows: list[tuple[list[float], int]], rng: random.Random, depth: int) -> Tree:
    share = round(SHARE * sum(y for _, y in rows) / len(rows))
    if not depth or share in (0, SHARE) or len(rows) < 2 * LEAST_LEAF:
        return share
    best = None
    for f in rng.sample(range(len(rows[0][0])), 6):
        at = sorted((x[f], y) for x, y in rows)
        total, left = sum(y for _, y in at), 0
        for i in range(1, len(at)):
            left += at[i - 1][1]
            if at[i][0] == at[i - 1][0] or i < LEAST_LEAF or len(at) - i < LEAST_LEAF:
                continue
            right = total - left
            gini = left * (i - left) / i + right * (len(at) - i - right) / (len(at) - i)
            if best is None or gini < best[0]:
                best = (gini, f, (at[i][0] + at[i - 1][0]) / 2)
    if best is None:
        return share
    _, f, cut = best
    low, high = [r for r in rows if r[0][f] <= cut], [r for r in rows if r[0][f] > cut]
    return f, cut, _grow(low, rng, depth - 1), _grow(high, rng, depth - 1)


@lru_cache
def forest(lines: int = FINDINGS, seed: int = SEED) -> tuple[Tree, ...]:
    """Trained on the driver, on the candidates of ``lines`` labelled lines."""
    rows, rng = labelled(lines, seed), random.Random(seed)
    return tuple(_grow(rng.choices(rows, k=len(rows)), rng, DEPTH) for _ in range(TREES))


def vote(tree: Tree, x: list[float]) -> int:
    while not isinstance(tree, int):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def score_of(x: list[float]) -> float:
    return sum(vote(t, x) for t in forest()) / (SHARE * TREES)


def _case(tree: Tree, name: Callable[[int], str]) -> str:
    if isinstance(tree, int):
        return str(tree)
    f, cut, low, high = tree
    return f"CASE WHEN {name(f)} <= {cut:g} THEN {_case(low, name)} ELSE {_case(high, name)} END"


def _score_sql(name: Callable[[int], str]) -> str:
    return f"CAST({' + '.join(_case(t, name) for t in forest())} AS DOUBLE) / {SHARE * TREES}"


def _one_line(x: str) -> str:
    return f"translate({x}, '\n\r', '  ')"


def _fast(by: Callable[[str], str]) -> str:
    """An expression of the candidate's pattern, with the short one where it says the same."""
    return f"CASE WHEN text RLIKE {Spark.text(HINT)} THEN {by(Spark.text(CANDIDATE))} ELSE {by(Spark.text(RUN))} END"


def _beside(j: str, found: str, parts: str) -> str:
    """A stretch between candidates with the candidate behind it, if there is one."""
    return f"concat(get({parts}, {j}), coalesce(get({found}, {j}), ''))"


def with_findings(docs: DataFrame, found: str = "_found", findings: str = "findings") -> DataFrame:
    """``docs`` with ``found``, all candidates with their names, and ``findings``: place, prefix, value, score, is_secret of each.

    Nothing is shuffled. Texts without a candidate, null and empty ones have an empty
    array. Columns of the two names are replaced, others stay; no rows, no rows.
    """
    q = Spark.text
    docs = docs.drop(found, findings).withColumn(found, F.expr(f"coalesce({_fast(lambda x: f'regexp_extract_all(text, {x}, 0)')}, array())"))
    split = _fast(lambda x: f"split(text, {x}, -1)")
    named = f"transform({found}, (m, i) -> struct(i, m, {Spark.prefix('m')} AS prefix))"
    valued = f"transform({named}, x -> struct(x.i, x.prefix, {_value('x.m', 'x.prefix', 'length', 'regexp_replace')} AS value))"
    wanted = f"filter({valued}, x -> x.prefix != '' OR x.value RLIKE {q(MIXED)})"
    left = f"right(concat(array_join(transform(sequence(greatest(x.i - {BACK}, 0), x.i), j -> if(j < x.i, {_beside('j', found, 'p')}, get(p, j))), ''), x.prefix), {LEFT})"
    right = f"left(concat(if(x.prefix LIKE '%://%' AND endswith(get({found}, x.i), '@'), '@', ''), array_join(transform(sequence(x.i + 1, x.i + {AHEAD}), j -> coalesce({_beside('j', found, 'p')}, '')), '')), {RIGHT})"
    placed = f"transform({wanted}, x -> struct(x.i, x.prefix, x.value, {_one_line(left)} AS l, {_one_line(right)} AS r))"
    columns = ", ".join(f"{f} AS f{i}" for i, f in enumerate(features(Spark, "x.value", "x.l", "x.r")))
    scored = f"transform(transform({placed}, x -> struct(x.i, x.prefix, x.value, {columns})), x -> struct(x.i, x.prefix, x.value, {_score_sql(lambda i: f'x.f{i}')} AS score))"
    marked = f"transform({scored}, x -> struct(x.i AS place, x.prefix, x.value, x.score, x.score >= 0.5 AS is_secret))"
    empty = "CAST(array() AS ARRAY<STRUCT<place: INT, prefix: STRING, value: STRING, score: DOUBLE, is_secret: BOOLEAN>>)"
    # The parts are made once for a text: a lambda over an array of one.
    each = f"flatten(transform(array({split}), p -> {marked}))"
    return docs.withColumn(findings, F.expr(f"CASE WHEN size({found}) > 0 THEN {each} ELSE {empty} END"))


def _value(m: str, prefix: str, length: str, replace: str) -> str:
    rest = f"substring({m}, {length}({prefix}) + 1)"
    return f"CASE WHEN {prefix} LIKE '%://%' THEN {replace}({rest}, '@$', '') ELSE {rest} END"


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, place, candidate, score, is_secret)``: a row for each candidate of each row of ``docs``; place counts the candidates by shape in a text.

    Null and empty texts have none; equal rows have equal findings; other columns are
    ignored; no rows, no rows.
    """
    found = with_findings(docs.select("doc_id", "text")).where(F.size("findings") > 0)
    return found.select("doc_id", F.explode("findings").alias("x")).select("doc_id", "x.place", F.col("x.value").alias("candidate"), "x.score", "x.is_secret")


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mask``, and ``n_chars``, if there, counted anew.

    All rows and columns stay, whatever their names; null and empty texts as they are.
    """
    found, findings, secret = apart(docs.columns, "_found", "_findings", "_secret")
    scanned = with_findings(docs, found, findings).withColumn(secret, F.expr(f"filter({findings}, x -> x.is_secret)"))
    parts = _fast(lambda x: f"split(text, {x}, -1)")
    masked = f"transform(filter({secret}, x -> x.place = i), x -> concat(x.prefix, {Spark.text(mask)}, if(endswith({found}[i], '@') AND x.prefix LIKE '%://%', '@', '')))"
    run = f"coalesce(get({masked}, 0), get({found}, i), '')"
    whole = f"array_join(transform({parts}, (t, i) -> concat(t, {run})), '')"
    out = scanned.withColumn("text", F.expr(f"CASE WHEN size({secret}) > 0 THEN {whole} ELSE text END"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(secret) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def oracle() -> str:
    q = Duck.text
    columns = ", ".join(f"{f} AS f{i}" for i, f in enumerate(features(Duck, "value", "l", "r")))
    back = f"array_to_string(list_transform(range(greatest(i - {BACK}, 0), i + 1), lambda j: parts[j + 1] || CASE WHEN j < i THEN found[j + 1] ELSE '' END), '')"
    ahead = f"array_to_string(list_transform(range(i + 1, i + 1 + {AHEAD}), lambda j: coalesce(parts[j + 1], '') || coalesce(found[j + 1], '')), '')"
    sign = "CASE WHEN prefix LIKE '%://%' AND found[i + 1] LIKE '%@' THEN '@' ELSE '' END"
    return f"""
WITH runs AS (
  SELECT doc_id, regexp_extract_all(text, {q(CANDIDATE)}) AS found, string_split_regex(text, {q(CANDIDATE)}) AS parts FROM documents
), each AS (
  SELECT doc_id, parts, found, unnest(range(0, len(found))) AS i FROM runs
), named AS (
  SELECT *, {Duck.prefix("found[i + 1]")} AS prefix FROM each
), valued AS (
  SELECT *, {_value("found[i + 1]", "prefix", "length", "regexp_replace")} AS value FROM named
), beside AS (
  SELECT doc_id, CAST(i AS INT) AS place, value, {_one_line(f"right({back} || prefix, {LEFT})")} AS l, {_one_line(f"left({sign} || {ahead}, {RIGHT})")} AS r
  FROM valued WHERE prefix != '' OR regexp_matches(value, {q(MIXED)})
), measured AS (
  SELECT doc_id, place, value, {columns} FROM beside
), scored AS (
  SELECT doc_id, place, value AS candidate, {_score_sql(lambda i: f"f{i}")} AS score FROM measured
)
SELECT *, score >= 0.5 AS is_secret FROM scored
"""
