"""Personal data: rules find what their format proves, and boosted trees add further spans from a wider net.

Rules (``BASE``) find addresses, network addresses, card and phone numbers. High-recall generators (``WIDE``) propose overlapping
spans of looser shapes. Of each candidate, features of its format and of its context are measured, gradient-boosted
trees score it, and per generator the least score that kept the wanted precision on a part set aside selects it. The
labels come from proofs that the features do not see: a rule's check inside the candidate or of its normal form (``(at)`` as
``@``, a national number as an international one), a key word right before a number, or a known prefix of a secret or a
key word and a sign right before it. Where a key word proves, key words and signs to the left are no features of that kind, so
the trees learn the format and what follows. Candidates that touch a rule's span are not added, so the least scores are
chosen without them; rules' spans stay. ``added`` reports how many spans of each kind the trees add.

All of it is column expressions over one row; nothing is exploded or shuffled but the bounded training sample of at most
``SAMPLE`` candidates, from documents chosen by hash, on which the trees are fitted.

Cases: a null or empty text has no spans. Matches that fail a rule's check are dropped without a second try. Spans count
code points, end exclusive. Without both kinds of labels nothing is added. Repeated rows are searched each; empty tables
give empty results; result columns replace columns with their names, others are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_DOCUMENTS, SAMPLE = 20_000, 20_000
TREES, DEPTH, RATE, BINS = 24, 3, 0.3, 16
PRECISION = 0.97

# Each pattern starts only where a run of its first class starts (or where the last match ended), and keeps what
# it has taken: the same matches as the plain patterns, in time linear in the text.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\s?(?:@|\(at\)|\[at\])\s?[A-Za-z0-9.-]{2,255}+",
    "number": r"(?<![0-9A-Za-z])[+(]?[0-9][0-9 ().-]{5,30}[0-9](?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_/+=-]{12,}+",
}
#: Kinds in the order of a span list.
KINDS = [*BASE, *WIDE]

_SECRET = r"^(?:AKIA|ASIA|ghp_|sk-|xox[bp]-)|(?i)(?:password|passwd|secret|token|api[_-]?key)="
_NAMED = r"(?i)(?<![a-z])(?:password|passwd|pwd|secret|token|api[_ -]?key|access[_ -]?key)[\"']?\s{0,2}[:=]\s{0,2}[\"']?$"
_CONTEXT = r"(?i)(?:mail|contact|call|phone|tel|fax|card|visa|account|iban|key|token|pass|secret|host|server|ip|addr)"
_AT = r"\s?(?:@|\(at\)|\[at\])\s?"
_ADDRESS = (
    r"^[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+"
    r"(?:(?i:com|org|net|edu|gov|mil|int|info|biz|name|app|dev)|[a-z]{2}|[A-Z]{2})[.-]*$")
_NATIONAL = r"(?:1[ .-])?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[0-9]{3}[ .-][0-9]{4}|\(0[1-9][0-9]{1,4}\) ?[0-9][0-9 .-]{3,}[0-9]"
_CALLED = r"(?i)(?<![a-z])(?:phone|telephone|tel|call|fax|mobile|cell)(?![a-z])[^0-9]{0,12}$"
_BLOCK = 64


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def find_spans(text: Column, pattern: str) -> Column:
    """All matches: array of ``start``, ``end``, ``body`` and the text ``left`` and ``right`` of it."""

    def prefix(values: Column, n: Column) -> Column:
        return F.aggregate(F.slice(values, F.lit(1), n), F.lit(0), lambda a, v: a + v)

    def placed(x: Column) -> Column:
        g, m, w = x["g"], x["m"], x["w"]
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(w) / _BLOCK).cast("int")), lambda b: F.aggregate(
            F.slice(w, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), lambda a, v: a + v))
        return _let(blocks, lambda k: _let(F.transform(k, lambda _, b: prefix(k, b)), lambda first: F.transform(m, lambda s, i: _let(
            F.element_at(first, F.floor(i / _BLOCK).cast("int") + 1)
            + F.aggregate(F.slice(w, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK), F.lit(0), lambda a, v: a + v)
            + F.length(g[i]),
            lambda start: F.struct(
                start.alias("start"), (start + F.length(s)).alias("end"), s.alias("body"),
                F.right(g[i], F.lit(24)).alias("left"), F.left(g[i + 1], F.lit(8)).alias("right"))))))

    cut = F.struct(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return _let(cut, lambda x: _let(F.struct(
        x["g"].alias("g"), x["m"].alias("m"),
        F.transform(x["m"], lambda s, i: F.length(x["g"][i]) + F.length(s)).alias("w")), placed))


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(a: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, -i, F.lit(1))) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return a + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _passes(kind: str, body: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(body, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(
            "^(?:[0-9]{0,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    return _let(_digits(body), lambda d: F.length(d).between(14, 19) & _luhn(d) if kind == "card" else
                F.length(d).between(10, 15))


def _may_have(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "address":
        return F.contains(text, F.lit("@")) | F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return F.lit(True)


_SPAN = "array<struct<kind:int,start:int,end:int,body:string,left:string,right:string>>"


def _found(kind: str, text: Column, check) -> Column:
    spans = F.transform(find_spans(text, (BASE | WIDE)[kind]), lambda s: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["body"].alias("body"),
        s["left"].alias("left"), s["right"].alias("right")))
    return F.when(_may_have(kind, text), F.filter(spans, check)).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base``, the rules' spans, and ``wide``, the generators' spans, in texts with a digit or an address sign."""
    t = F.coalesce(F.col(text), F.lit(""))
    worth = t.rlike(r"[0-9@]|[(\[]at[)\]]")
    none = F.array().cast(_SPAN)

    def rule(kind: str):
        return lambda s: _passes(kind, s["body"])

    def shape(kind: str):
        return lambda s: s["body"].rlike("[0-9]") if kind == "secret" else F.lit(True)

    base = F.concat(*[_found(kind, t, rule(kind)) for kind in BASE])
    wide = F.concat(*[_found(kind, t, shape(kind)) for kind in WIDE])
    return df.withColumns({"base": F.when(worth, base).otherwise(none), "wide": F.when(worth, wide).otherwise(none)})


def free(s: Column) -> Column:
    """Whether a generator's span touches no span of a rule and may be added."""
    return ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


def proof(s: Column) -> Column:
    """The label of a candidate of a generator.

    A rule's span inside a candidate touches it, so among the candidates that may be added the normal form of an address
    or number and the key word before a number count.
    """
    body = s["body"]
    national = body.rlike(f"^(?:{_NATIONAL})(?: (?:{_NATIONAL}))*$") & (F.length(_digits(body)) >= 10)
    called = s["left"].rlike(_CALLED) & F.length(_digits(body)).between(7, 15)
    rules = {
        "address": body.rlike(BASE["email"].replace(r"(?:\G|", "(?:")) | F.regexp_replace(body, _AT, "@").rlike(_ADDRESS),
        "number": F.exists(F.regexp_extract_all(body, F.lit(BASE["card"]), F.lit(0)), lambda m: _passes("card", m))
        | F.exists(F.regexp_extract_all(body, F.lit(BASE["phone"]), F.lit(0)), lambda m: _passes("phone", m))
        | F.exists(F.regexp_extract_all(body, F.lit(BASE["ip"]), F.lit(0)), lambda m: _passes("ip", m))
        | national | called,
        "secret": body.rlike(_SECRET) | s["left"].rlike(_NAMED),
    }
    out = F.lit(False)
    for kind, rule in rules.items():
        out = F.when(s["kind"] == KINDS.index(kind), rule).otherwise(out)
    return out


def features(s: Column) -> dict[str, Column]:
    """Numbers that describe the format and the context of a candidate; what proves a kind from the left is not told for it."""
    body, left, right = s["body"], s["left"], s["right"]
    size = F.length(body)

    def share(kind: str) -> Column:
        return (size - F.length(F.regexp_replace(body, kind, ""))) / size

    return {
        "kind": s["kind"].cast("double"),
        "length": size.cast("double"),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "dots": share(r"\."),
        "dashes": share("[-_/]"),
        "blanks": share(r"\s"),
        "brackets": share(r"[()\[\]]"),
        "starts_with_plus": body.startswith("+").cast("double"),
        "distinct": F.size(F.array_distinct(F.split(body, ""))) / size,
        "longest_digits": F.coalesce(F.array_max(F.transform(F.split(body, "[^0-9]+"), F.length)), F.lit(0)).cast("double"),
        "changes": (F.size(F.split(body, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")) - 1).cast("double"),
        "hex": share("[0-9a-fA-F]"),
        "key_word_before": ((s["kind"] == KINDS.index("address")) & left.rlike(_CONTEXT)).cast("double"),
        "sign_before": ((s["kind"] != KINDS.index("secret")) & left.rlike(r"[:=]\s?$")).cast("double"),
        "quote_after": right.rlike("^[\"']").cast("double"),
        "blank_after": (right.rlike(r"^\s") | (right == "")).cast("double"),
    }


NAMES = [
    "kind", "length", "digits", "upper", "lower", "dots", "dashes", "blanks", "brackets", "starts_with_plus", "distinct",
    "longest_digits", "changes", "hex", "key_word_before", "sign_before", "quote_after", "blank_after"]


@dataclass
class Trees:
    """Sum of trees over a start value, and the least score per generator; a tree is (feature, cut, low, high) or a value."""

    start: float = 0.0
    trees: list = field(default_factory=list)
    least: dict[str, float] = field(default_factory=dict)

    def raw(self, x: np.ndarray) -> np.ndarray:
        def walk(tree, rows: np.ndarray) -> np.ndarray:
            if not isinstance(tree, tuple):
                return np.full(len(rows), tree)
            f, cut, low, high = tree
            out, on = np.empty(len(rows)), rows[:, f] <= cut
            out[on], out[~on] = walk(low, rows[on]), walk(high, rows[~on])
            return out

        return self.start + sum((walk(t, x) for t in self.trees), np.zeros(len(x)))

    def score(self, values: dict[str, Column]) -> Column:
        """The same sum as a column."""

        def walk(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            f, cut, low, high = tree
            return F.when(values[NAMES[f]] <= float(cut), walk(low)).otherwise(walk(high))

        out = F.lit(float(self.start))
        for tree in self.trees:
            out = out + walk(tree)
        return out


def grow(x: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int, least: float = 2.0):
    """A tree of Newton steps for given first and second derivatives of the loss."""
    value = RATE * slope.sum() / (curve.sum() + 1.0)
    best = (1e-6, None, None)
    if depth:
        whole = slope.sum() ** 2 / (curve.sum() + 1.0)
        for f in range(x.shape[1]):
            for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[:-1], method="lower")):
                on = x[:, f] <= cut
                a, b = curve[on].sum(), curve[~on].sum()
                if min(a, b) * 4 >= least:
                    gain = slope[on].sum() ** 2 / (a + 1.0) + slope[~on].sum() ** 2 / (b + 1.0) - whole
                    if gain > best[0]:
                        best = (gain, f, cut)
    if best[1] is None:
        return float(value)
    on = x[:, best[1]] <= best[2]
    return (best[1], float(best[2]), grow(x[on], slope[on], curve[on], depth - 1), grow(x[~on], slope[~on], curve[~on], depth - 1))


def boost(x: np.ndarray, y: np.ndarray, learn: np.ndarray, aside: np.ndarray, kinds: np.ndarray, precision: float = PRECISION) -> Trees:
    """Fit trees to the labels ``y`` of rows ``learn`` by gradient boosting of the logistic loss; rows ``aside`` set the least scores."""
    model = Trees()
    if not 0 < y[learn].sum() < learn.sum():
        return model
    share = y[learn].mean()
    model.start = float(np.log(share / (1 - share)))
    total = np.full(learn.sum(), model.start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        tree = grow(x[learn], y[learn] - p, p * (1 - p), DEPTH)
        model.trees.append(tree)
        total += Trees(0.0, [tree]).raw(x[learn])
    raw = model.raw(x)
    for kind in WIDE:
        some = np.flatnonzero(aside & (kinds == KINDS.index(kind)))
        some = some[np.argsort(-raw[some], kind="stable")]
        if len(some):
            right = np.cumsum(y[some]) / np.arange(1, len(some) + 1)
            ends = np.concatenate([raw[some][1:] < raw[some][:-1], [True]])  # equal scores stay together
            fine = np.flatnonzero(ends & (right >= precision))
            if len(fine):
                model.least[kind] = float(raw[some][fine[-1]])
    return model


def fit(df: DataFrame, text: str = "text", documents: int = SAMPLE_DOCUMENTS, sample: int = SAMPLE) -> Trees:
    """Fit on candidates of at most about ``documents`` documents, chosen by hash, and at most ``sample`` candidates.

    Candidates that touch a rule's span are never added: the trees learn from them too, but the share of right ones counts
    without them.
    """
    total = max(df.count(), 1)
    share = min(1_000_000, int(1_000_000 * documents / total) + 1)
    some = df.select(F.col(text).alias("t")).filter(F.pmod(F.xxhash64("t"), F.lit(1_000_000)) < share)
    spans = candidates(some, "t").select("base", F.explode("wide").alias("s"))
    chosen = spans.select(
        F.pmod(F.xxhash64(F.col("s.body")), F.lit(1_000)).alias("h"), proof(F.col("s")).cast("double").alias("y"),
        free(F.col("s")).cast("double").alias("may"),
        *[v.alias(n) for n, v in features(F.col("s")).items()])
    rows = chosen.orderBy("h", *NAMES, "y", "may").limit(sample).collect()
    if not rows:
        return Trees()
    table = np.array([tuple(float(v) for v in r) for r in rows])
    aside = table[:, 0] % 3 == 0
    return boost(table[:, 3:], table[:, 1], ~aside, aside & (table[:, 2] == 1), table[:, 3])


def find_pii(df: DataFrame, model: Trees, text: str = "text") -> DataFrame:
    """Add ``base`` and ``spans`` (rules' and added ones), arrays of kind (place in ``KINDS``), start, end and body, sorted."""

    def plain(spans: Column) -> Column:
        return F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["body"].alias("body"))))

    df = candidates(df.drop("base", "wide", "spans"), text)
    if model.least:
        def wanted(s: Column) -> Column:
            values = F.struct(*[v.alias(n) for n, v in features(s).items()])
            enough = F.lit(None).cast("double")
            for kind, least in model.least.items():
                enough = F.when(s["kind"] == KINDS.index(kind), F.lit(least)).otherwise(enough)
            return _let(values, lambda v: F.coalesce(model.score({n: v[n] for n in NAMES}) >= enough, F.lit(False)))

        added = F.filter(F.filter("wide", free), wanted)
    else:
        added = F.array().cast(_SPAN)
    return df.withColumns({"spans": plain(F.concat("base", added)), "base": plain(F.col("base"))}).drop("wide")


def added(found: DataFrame) -> DataFrame:
    """``kind, n``: how many spans of each kind stand beside those of the rules, of a result of ``find_pii``."""
    extra = found.select(F.explode(F.array_except("spans", "base")).alias("s"))
    return extra.groupBy(F.array(*[F.lit(k) for k in KINDS])[F.col("s.kind")].alias("kind")).agg(F.count("*").alias("n"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every stretch of touching spans replaced by the kind of its first, in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        part = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], F.array(part, names[s["kind"]]))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, start, add, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.greatest(F.length(text) - acc["at"], F.lit(0)))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
