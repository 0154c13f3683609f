"""Personal data by candidates and boosted trees, with DataFrame functions only.

Generators with high recall propose spans that may overlap: every match of a base pattern,
valid or not, and of looser patterns (obfuscated addresses, numbers without a country code,
other separators). Boosted trees over format and context features, which do not see the
validity tests, learn from the base matches which shapes and surroundings go with valid data.
The threshold of each kind is calibrated for a given precision on the candidates of all held-out
documents, a fifth of the corpus; candidates beyond the base spans that reach it are added.

Positions come from splitting a text at the matches: the lengths of the pieces and matches add up
to offsets in code points. Trees are grown level by level from grouped sums of gradients for each
(node, feature, value); only those sums, a few thousand rows, come to the driver. Quantifiers are
possessive, and matches begin at run starts, so that long runs cost linear time and no stack.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import keep

KINDS = ("email", "ip", "card", "phone")
#: Base patterns, in a form that does no needless backtracking but finds the same matches.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){13,}+",  # fewer than 14 digits never pass
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser patterns: what their matches are is left to the trees.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:[_:\x20-][0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}+(?:[./_][0-9]{4}+){3}+(?![0-9])",
    "phone": r"(?<![0-9+])(?:00[0-9]{1,3}+[\x20.-])?+\(?+[0-9]{3}+\)?+[\x20.-][0-9]{3}+[\x20.-][0-9]{4}+(?![0-9])",
}
#: One of these a text must hold for a pattern to match at all (a plain search, much cheaper).
MUST = {"email": ("@",), "phone": ("+",)}
LOOSE_MUST = {"email": ("at", "AT")}
FEATURES = ("kind", "digits", "chars", "letters", "dots", "dashes", "blanks", "brackets", "plus", "groups", "longest", "word_before", "word_after", "assigned", "named", "distinct")
SAMPLE_DOCS, SAMPLE_ROWS = 20_000, 40_000
TREES, DEPTH, RATE, L2, VALUES = 10, 3, 0.4, 1.0, 32
PRECISION, LEAST_ROWS, FOLDS = 0.98, 20, 5
_UNIT = 1_000_000
_WORD = r"[A-Za-z0-9_]"
_CUES = {"email": "mail|contact|write", "ip": "ip|host|server|address", "card": "card|visa|pay|iban", "phone": "phone|tel|call|fax|mobile"}


_NO_SPANS = "array<struct<s:int,e:int,m:string>>"
_CHUNK = 200


def spans(found: Column, pieces: Column) -> Column:
    """Array of (s, e, m) from the matches and the pieces of the text between them, offsets in code points, end exclusive.

    Lengths are added up within chunks first, then over the chunks, so that an array is only ever
    extended to _CHUNK entries and a text full of matches takes no quadratic time.
    """
    empty = F.array().cast(_NO_SPANS)

    def step(acc, pair):
        s = acc["at"] + F.length(pair["p"])
        e = s + F.length(pair["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), pair["m"].alias("m")))).alias("out"))

    def shifted(chunk, start):
        return F.transform(chunk["out"], lambda x: F.struct((x["s"] + start).alias("s"), (x["e"] + start).alias("e"), x["m"].alias("m")))

    def of_chunk(j):
        pairs = F.zip_with(F.slice(pieces, j * _CHUNK + 1, F.lit(_CHUNK)), F.slice(found, j * _CHUNK + 1, F.lit(_CHUNK)), lambda p, m: F.struct(p.alias("p"), m.alias("m")))
        return F.aggregate(F.filter(pairs, lambda x: x["m"].isNotNull()), F.struct(F.lit(0).alias("at"), empty.alias("out")), step)

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _CHUNK).cast("int")), of_chunk)
    joined = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_NO_SPANS}>").alias("out")),
                         lambda acc, c: F.struct((acc["at"] + c["at"]).alias("at"), F.concat(acc["out"], F.array(shifted(c, acc["at"]))).alias("out")))["out"]
    return F.when(F.size(found) > 0, F.flatten(joined)).otherwise(empty)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    at = F.sequence(F.lit(1), n)

    def add(total, i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(at, F.lit(0), add) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    """Whether a base match passes the kind's test."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda x: (F.length(F.ltrim(x, F.lit("0"))) <= 3) & (F.coalesce(F.substring(F.concat(F.lit("0"), F.ltrim(x, F.lit("0"))), -4, 4).cast("int"), F.lit(0)) <= 255))
    n = F.length(_digits(m))
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(m))).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def with_candidates(docs: DataFrame, text: Column, out: str = "_c") -> DataFrame:
    """``docs`` with an array of (k, s, e, base, m): matches of all patterns; base is true or false for base matches, null for looser ones.

    Each pattern runs once over a text, and once more to cut it where there are matches.
    """
    def told(k: int, base):
        return lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"), base(x["m"]).alias("base"), x["m"].alias("m"))

    searches = [(k, pattern, must.get(kind), base) for k, kind in enumerate(KINDS)
                for pattern, must, base in ((BASE[kind], MUST, partial(valid, kind)), (LOOSE[kind], LOOSE_MUST, lambda m: F.lit(None).cast("boolean")))]
    no_text = F.array().cast("array<string>")
    found, pieces = {}, {}
    for i, (_, pattern, must, _) in enumerate(searches):
        got = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        found[f"_f{i}"] = F.when(reduce(or_, [text.contains(m) for m in must]), got).otherwise(no_text) if must else got
        pieces[f"_p{i}"] = F.when(F.size(f"_f{i}") > 0, F.split(text, pattern, -1)).otherwise(no_text)
    parts = [F.transform(spans(F.col(f"_f{i}"), F.col(f"_p{i}")), told(k, base)) for i, (k, _, _, base) in enumerate(searches)]
    return docs.withColumns(found).withColumns(pieces).withColumn(out, F.concat(*parts)).drop(*found, *pieces)


def features(text: Column, c: Column) -> Column:
    """Array of small integers, one a FEATURES entry, of a candidate struct in its text."""
    m, s, e = c["m"], c["s"], c["e"]
    count = lambda pattern: F.length(m) - F.length(F.regexp_replace(m, pattern, ""))
    before = F.lower(F.substring(text, F.greatest(s - 23, F.lit(1)), F.least(s, F.lit(24))))
    after = F.substring(text, e + 1, F.lit(1))
    groups = F.filter(F.split(m, "[^0-9]+"), lambda x: x != "")
    named = F.lit(False)
    for k, kind in enumerate(KINDS):
        named = named | ((c["k"] == k) & before.rlike(_CUES[kind]))
    values = [c["k"], count("[0-9]"), F.length(m), count("[A-Za-z]"), count(r"\."), count("-"), count(r"\x20"), count(r"[\[\]()]"), m.startswith("+").cast("int"), F.size(groups),
              F.coalesce(F.array_max(F.transform(groups, lambda x: F.length(x))), F.lit(0)), before.rlike(_WORD + r"\z").cast("int"), after.rlike(_WORD).cast("int"),
              before.rlike("[=\":][\"\\x20]?\\z").cast("int"), named.cast("int"), F.size(F.array_distinct(F.split(_digits(m), "")))]
    return F.array(*[F.least(v.cast("int"), F.lit(VALUES - 1)) for v in values])


@dataclass
class Boosted:
    """Trees as nested tuples (feature, value, low, high) or leaf values; thresholds of the kinds (None: add none)."""

    trees: list
    bias: float
    thresholds: dict[str, float | None]

    def margin(self, x: Column) -> Column:
        def walk(tree):
            return F.lit(float(tree)) if not isinstance(tree, tuple) else F.when(x[tree[0]] <= tree[1], walk(tree[2])).otherwise(walk(tree[3]))

        total = F.lit(self.bias)
        for t in self.trees:
            total = total + walk(t)
        return total

    def probability(self, x: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-self.margin(x)))


def _leaf(g: float, h: float) -> float:
    return -RATE * g / (h + L2)


def _grow(rows: DataFrame) -> tuple:
    """One tree from rows (x, g, h), gradients in units of 1/_UNIT so that sums do not depend on their order."""
    tree: dict[int, tuple[int, int]] = {}
    leaves: dict[int, float] = {}
    open_ = [0]
    for depth in range(DEPTH + 1):
        node = F.lit(0)
        for d in range(depth):  # the place of a row in the tree so far
            step = node
            for i in [i for i in tree if 2**d - 1 <= i < 2 ** (d + 1) - 1]:
                f, v = tree[i]
                step = F.when(node == i, F.when(F.col("x")[f] <= v, 2 * i + 1).otherwise(2 * i + 2)).otherwise(step)
            node = step
        at = rows.select(node.alias("node"), "g", "h", F.posexplode("x").alias("f", "v")).where(F.col("node").isin(open_))
        sums: dict = {}
        for r in at.groupBy("node", "f", "v").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():  # nodes x features x values
            sums.setdefault(r.node, {}).setdefault(r.f, {})[r.v] = (r.g / _UNIT, r.h / _UNIT)
        following = []
        for i in open_:
            if i not in sums:
                leaves[i] = 0.0
                continue
            gt, ht = (sum(x[k] for x in sums[i][0].values()) for k in (0, 1))
            best = (1e-6, None)
            for f in sorted(sums[i]):
                g = h = 0.0
                for v in sorted(sums[i][f])[:-1]:
                    g, h = g + sums[i][f][v][0], h + sums[i][f][v][1]
                    gain = g * g / (h + L2) + (gt - g) ** 2 / (ht - h + L2) - gt * gt / (ht + L2)
                    if gain > best[0] + 1e-9 and min(h, ht - h) > 0.5:
                        best = (gain, (f, v))
            if depth == DEPTH or best[1] is None:
                leaves[i] = _leaf(gt, ht)
            else:
                tree[i] = best[1]
                following += [2 * i + 1, 2 * i + 2]
        open_ = following
        if not open_:
            break
    build = lambda i: leaves.get(i, 0.0) if i not in tree else (*tree[i], build(2 * i + 1), build(2 * i + 2))
    return build(0)


def _judged(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Base matches of ``docs``, valid or not: i, s, k, features x and y (1.0: valid)."""
    some = with_candidates(docs.select(F.col(id_col).alias("i"), F.coalesce(text_col, F.lit("")).alias("t")), F.col("t"), "c")
    told = F.transform("c", lambda c: F.struct(features(F.col("t"), c).alias("x"), c["base"].cast("double").alias("y"), c["k"].alias("k"), c["s"].alias("s")))
    return some.select("i", F.explode(told).alias("c")).select("i", "c.*").where("y is not null")


def calibrate(model: Boosted, held: DataFrame) -> dict[str, float | None]:
    """The least threshold of each kind at which PRECISION of the held-out matches that reach it are valid.

    Sums over all rows (k, x, y), grouped by kind. A kind with fewer than LEAST_ROWS such matches
    takes the threshold of all kinds together; None where no threshold is precise enough.
    """
    grid = [k / 50 for k in range(25, 50)]
    sums = [x for i, t in enumerate(grid) for x in (F.sum(F.when(F.col("p") >= t, F.col("y"))).alias(f"y{i}"), F.count(F.when(F.col("p") >= t, 1)).alias(f"n{i}"))]
    by_kind = {r.k: r for r in held.select("k", "y", model.probability(F.col("x")).alias("p")).groupBy("k").agg(*sums).collect()}  # one row a kind

    def least(kinds):
        n = [sum(by_kind[k][f"n{i}"] for k in kinds) for i in range(len(grid))]
        y = [sum(by_kind[k][f"y{i}"] or 0 for k in kinds) for i in range(len(grid))]
        return min((t for i, t in enumerate(grid) if n[i] >= LEAST_ROWS and y[i] >= PRECISION * n[i]), default=None)

    many = {k for k, r in by_kind.items() if r.n0 >= LEAST_ROWS}
    return {kind: least([k] if k in many else list(by_kind)) for k, kind in enumerate(KINDS)}


def train(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Boosted:
    """Trees from the base matches in a sample of about SAMPLE_DOCS documents, at most SAMPLE_ROWS of them; thresholds from all held-out documents.

    A document is held out if the crc32 of its id is divisible by FOLDS (a null id counts as empty
    text); repeated rows count as often as they are there, and an empty table adds nothing.
    """
    of_id = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0
    n = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(n, 1))
    draw = F.shiftrightunsigned(F.xxhash64(id_col, F.lit(5)), 11) / F.lit(float(1 << 53))
    rows = _judged(docs.where((draw < share) & ~of_id), text_col, id_col).orderBy(F.xxhash64("i", "s", "k"), "i", "s", "k").limit(SAMPLE_ROWS)
    fit = keep(rows.select("x", "y"), "pii-sample")
    s = fit.agg(F.sum("y").alias("p"), F.count("*").alias("n")).first()
    p, n = s.p or 0.0, s.n or 0
    model = Boosted([], math.log((p + 1) / (n - p + 1)), dict.fromkeys(KINDS))
    if not 0 < p < n:
        return model
    fit = fit.withColumn("margin", F.lit(model.bias))
    for _ in range(TREES):
        q = 1.0 / (1.0 + F.exp(-F.col("margin")))
        now = keep(fit.select("x", "y", "margin", F.round((q - F.col("y")) * _UNIT).cast("long").alias("g"), F.round(q * (1 - q) * _UNIT).cast("long").alias("h")), "pii-boost")
        tree = _grow(now)
        model.trees.append(tree)
        fit = now.select("x", "y", (F.col("margin") + Boosted([tree], 0.0, {}).margin(F.col("x"))).alias("margin"))
    model.thresholds = calibrate(model, _judged(docs.where(of_id), text_col, id_col))
    return model


def find(docs: DataFrame, model: Boosted, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of (start, kind number, end, text), by start, then kind.

    Null and empty texts have empty arrays. ``added`` holds candidates that reach their kind's
    threshold and do not lie within a base span. Columns named base or added are replaced.
    """
    docs = docs.drop("base", "added")
    text = F.coalesce(F.col(text_col), F.lit(""))
    described = lambda c: F.struct(*[c[n].alias(n) for n in ("k", "s", "e", "base", "m")], features(text, c).alias("x"))
    got = with_candidates(docs, text)
    got = got.withColumn("_c", F.transform("_c", described))
    slim = lambda c: F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e"), c["m"].alias("m"))
    got = got.withColumn("base", F.array_sort(F.transform(F.filter("_c", lambda c: F.coalesce(c["base"], F.lit(False))), slim)))

    def chosen(c):
        enough = F.lit(False)
        score = model.probability(c["x"])
        for k, kind in enumerate(KINDS):
            if model.thresholds.get(kind) is not None:
                enough = enough | ((c["k"] == k) & (score >= model.thresholds[kind]))
        covered = F.exists(F.col("base"), lambda b: (b["s"] <= c["s"]) & (c["e"] <= b["e"]))
        return ~F.coalesce(c["base"], F.lit(False)) & ~covered & enough

    got = got.withColumn("added", F.array_sort(F.array_distinct(F.transform(F.filter("_c", chosen), slim))))
    return got.drop("_c")


def listed(spans: Column, names: tuple[str, ...]) -> Column:
    """kind:start:end of (start, kind number, end) structs, comma-joined."""
    name = lambda k: F.element_at(F.array(*[F.lit(n) for n in names]), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, counts of the base spans by kind, base_sha256, all spans as a string, and the number of added ones."""
    slim = lambda spans: F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    every = F.array_sort(F.concat(slim(F.col("base")), slim(F.col("added"))))
    of = lambda k: lambda x: x["k"] == k
    return found.select(F.col(id_col).alias("doc_id"), *[F.size(F.filter("base", of(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
                        F.sha2(listed(F.col("base"), KINDS).cast("binary"), 256).alias("base_sha256"), listed(every, KINDS).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))
