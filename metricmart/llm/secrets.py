"""Secret scans through a trigram inverted index; DataFrame operations throughout.

Each rule's regular expression yields a Boolean query over three-letter strings that any match must
hold (lower-cased): an OR of ANDs. The index has postings (trigram, text) for the trigrams of the
queries. A rule's candidates are the texts whose postings meet one of its ANDs; only those
are searched with the expression. Rules without a mandatory trigram scan every text. Texts are
known by a 64-bit hash in the index, so copies share postings; a shared hash can only add a
candidate, since the expression decides on the text itself.

Defined results: null and empty texts have no spans; repeated rows and copies each give a row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import product
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .spans import find, in_order, joined, no_spans

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, expression, whether letters match in either case
BASE = (("assign", ASSIGN, True), ("access", r"AKIA[A-Z0-9]+", False), ("hex", r"[0-9a-f]{32,}", False))
#: rules of the method's own: formats that name themselves
MORE = (("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", False), ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", False),
        ("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}", False), ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", False))
RULES = BASE + MORE
KINDS = tuple(k for k, _, _ in RULES)
MOST_STRINGS = 24  # alternatives that are followed through a sequence before they are cut


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """An OR of ANDs of lower-case trigrams that every match holds; [{}] means: none is mandatory."""
    def both(a, b):
        got = {x | y for x, y in product(a, b)}
        return got if len(got) <= MOST_STRINGS else {frozenset()}

    def of(strings):  # a match holds one of these strings
        return {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}

    def walk(items):
        """(all strings that this can be, and a query for none; or None, and a query for the whole)"""
        strings, query, whole = {""}, {frozenset()}, True
        for op, arg in items:
            name, exact, inner = str(op), None, {frozenset()}
            if name == "LITERAL":
                exact = {chr(arg).lower()}
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
                exact = {chr(a).lower() for _, a in arg}
            elif name == "SUBPATTERN":
                exact, inner = walk(arg[-1])
            elif name == "BRANCH":
                parts = [walk(x) for x in arg[1]]
                if all(e is not None and q == {frozenset()} for e, q in parts):
                    exact = set().union(*(e for e, _ in parts))
                else:
                    inner = set().union(*(both(of(e), q) if e is not None else q for e, q in parts))
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                low, high, body = arg
                e, q = walk(body)
                if (low, high) == (0, 1) and e is not None and q == {frozenset()}:
                    exact = e | {""}
                elif low == high == 1:
                    exact, inner = e, q
                elif low:
                    inner = both(of(e), q) if e is not None else q
            if exact is not None and len(strings) * len(exact) <= MOST_STRINGS:
                query, strings = both(query, inner), {a + b for a in strings for b in exact}
            else:  # what was exact so far ends here
                query = both(both(query, of(strings)), inner)
                strings, whole = exact if exact is not None else {""}, False
        return (strings, query) if whole else (None, both(query, of(strings)))

    strings, query = walk(parser.parse(pattern))
    found = query if strings is None else both(query, of(strings))
    return sorted((x for x in found if not any(y < x for y in found)), key=sorted)


def _search(text: Column, kind: str, pattern: str, fold: bool) -> Column:
    spans = find(text, kind, ("(?i)" if fold else "") + pattern)
    if kind == "access":
        return F.filter(spans, lambda s: F.char_length(s["match"]) >= 16)
    if kind == "assign":  # the match alone parses as it did in the text
        return F.filter(spans, lambda s: F.char_length(F.regexp_extract(s["match"], "(?i)" + pattern, 2)) >= 8)
    return spans


def candidates(texts: DataFrame, rules=RULES) -> DataFrame:
    """``key`` and ``rules``, a bit for each rule whose trigram query the text meets (no row: none)."""
    queries = [trigram_query(p) for _, p, _ in rules]
    needed = sorted(set().union(*(t for q in queries for t in q)))
    lits = F.array(*[F.lit(t) for t in needed])
    # the text is lower-cased once, as the one element of an array
    found = lambda low: F.filter(F.sequence(F.lit(0), F.lit(len(needed) - 1)), lambda i: F.contains(low, F.get(lits, i)))
    present = F.get(F.transform(F.array(F.lower("text")), found), F.lit(0))
    postings = stored(texts.select("key", F.explode(present).alias("trigram")).distinct(), "postings")
    place = {t: i for i, t in enumerate(needed)}
    words = [F.bit_or(F.when(F.floor(F.col("trigram") / 62) == w, F.expr("shiftleft(1L, cast(trigram % 62 AS int))")).otherwise(F.lit(0).cast("long"))).alias(f"w{w}")
             for w in range(len(needed) // 62 + 1)]

    def holds(every: frozenset[str]) -> Column:
        out = F.lit(True)
        for w in range(len(words)):
            mask = sum(1 << (place[t] % 62) for t in every if place[t] // 62 == w)
            out = out & (F.col(f"w{w}").bitwiseAND(F.lit(mask).cast("long")) == F.lit(mask).cast("long"))
        return out

    met = []
    for i, q in enumerate(queries):
        if frozenset() not in q:
            any_of = holds(q[0])
            for every in q[1:]:
                any_of = any_of | holds(every)
            met.append(F.when(any_of, F.lit(1 << i)).otherwise(F.lit(0)))
    lists = postings.groupBy("key").agg(*words)
    return lists.select("key", sum(met[1:], met[0]).alias("rules")).where("rules > 0")


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id and ``spans`` of every rule, found through the index or, without trigrams, by a full scan."""
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    found = keyed.join(candidates(keyed, rules), "key", "left")
    each = []
    for i, (kind, pattern, fold) in enumerate(rules):
        got = _search(F.col("text"), kind, pattern, fold)
        if frozenset() not in trigram_query(pattern):
            got = F.when(F.coalesce(F.col("rules"), F.lit(0)).bitwiseAND(F.lit(1 << i)) != 0, got).otherwise(no_spans())
        each.append(got)
    return found.select("doc_id", F.concat(*each).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base kinds, and all spans, of each document."""
    base = [k for k, _, _ in BASE]
    got = scan(docs).withColumn("spans", in_order(F.col("spans"), KINDS, by_start=True))
    got = got.withColumn("base", F.filter("spans", lambda s: s["kind"].isin(base)))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return got.select("doc_id", *[count(k) for k in base], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
