"""Personal data by candidate gradient boosting.

Generators of high recall propose spans, which may overlap. Spans of the base rules always
stand. The other candidates are scored by boosted trees over features of their format and
of the text around them, and those over their kind's calibrated threshold are taken too.
Proposing, features, trees and choice are column expressions on the row itself: no text is
moved, and no Python runs on the executors. The trees are fitted on a bounded sample of
labelled candidates that ``labelled`` composes from a rule, and become CASE expressions.
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from functools import lru_cache

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
SAMPLE = 2_400  # labelled candidates for fitting and calibration
HELD_OUT = 3  # every third of them calibrates
PRECISION = 0.98  # that a threshold must reach on the held-out ones
TREES, DEPTH = 12, 3
AROUND = 24  # characters of context


@dataclass(frozen=True)
class Generator:
    kind: str
    pattern: str
    base: bool = False
    needs: str = ""  # a literal without which the pattern cannot match


#: Base patterns find what their plain forms find, leftmost and non-overlapping: a match can
#: only start where a run of its first class starts or where the last match ended, and
#: possessive repeats give nothing back, so long runs cost linear time.
GENERATORS = (
    Generator(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        True,
        "@",
    ),
    Generator("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True, "."),
    Generator("card", r"[0-9](?:[ -]?[0-9])++", True),
    Generator("phone", r"\+[0-9][ ().0-9-]+[0-9]", True, "+"),
    Generator(
        "email",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]|\{at\}) ?"
        r"[A-Za-z0-9-]{1,63}+(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.) ?[A-Za-z0-9-]{1,63}+){1,8}",
        needs="at",
    ),
    Generator("ip", r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", needs=":"),
    Generator("phone", r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
)

FEATURES = [
    "length", "digits", "letters", "separators", "luhn", "dots", "colons", "brackets",
    "kind", "cue", "other_cue", "digit_before", "letter_before", "digit_after", "letter_after",
]
CUES = {
    "email": "mail|contact|write|reach",
    "ip": "ip|host|addr|server|from",
    "card": "card|visa|credit|pay|account",
    "phone": "phone|tel|call|mobile|fax|dial",
}
OTHER_CUES = "order|invoice|version|isbn|serial|ticket|part no|build|ref|sku|total"


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _placed(text: Column, found: Column, g: Generator) -> Column:
    """Structs (kind, base, start, end, value) of the matches: the pieces between two matches
    are what splitting by the same pattern leaves, so starts are running sums of lengths."""
    pieces = F.zip_with(F.split(text, g.pattern, -1), found, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    span = "struct<kind: int, base: boolean, start: int, end: int, value: string>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(done: Column, piece: Column) -> Column:
        start = done["at"] + F.length(piece["gap"])
        end = start + F.coalesce(F.length(piece["hit"]), F.lit(0))
        one = F.struct(
            F.lit(KINDS.index(g.kind)).alias("kind"),
            F.lit(g.base).alias("base"),
            start.alias("start"),
            end.alias("end"),
            piece["hit"].alias("value"),
        )
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(one)).alias("spans"))

    spans = F.aggregate(pieces, zero, step, lambda done: done["spans"])
    empty = F.array().cast(f"array<{span}>")
    return F.when(F.size(found) > 0, F.filter(spans, lambda s: s["value"].isNotNull())).otherwise(empty)


def _count(value: Column, drop: str) -> Column:
    """Characters of ``value`` outside the class ``drop``."""
    return F.length(F.regexp_replace(value, drop, ""))


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes the Luhn check; longer ones are no card."""
    n = F.length(digits)
    at = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))

    def add(total: Column, i: Column) -> Column:
        d = F.coalesce(F.substr(digits, n - i + 1, F.lit(1)).try_cast("int"), F.lit(0))
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.when(n <= 19, F.aggregate(at, F.lit(0), add) % 10 == 0).otherwise(F.lit(False))


def _valid(c: Column) -> Column:
    """What the base rules ask of a match of their pattern."""
    digits = F.regexp_replace(c["value"], "[^0-9]", "")
    n = F.length(digits)
    parts = F.forall(F.split(c["value"], r"\."), lambda p: F.ltrim(p, F.lit("0")).rlike(
        "^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
    ))
    return (
        F.when(c["kind"] == 0, True)
        .when(c["kind"] == 1, parts)
        .when(c["kind"] == 2, n.between(12, 19) & luhn(digits))
        .otherwise(n.between(9, 15))
    )


def _features(text: Column, c: Column) -> Column:
    """Numbers about a candidate's format and what stands around it."""
    value = c["value"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    before = F.lower(F.substr(text, F.greatest(c["start"] - AROUND + 1, F.lit(1)), F.least(c["start"], F.lit(AROUND))))
    after = F.substr(text, c["end"] + 1, F.lit(1))
    cue = F.lit(False)
    for k, name in enumerate(KINDS):
        cue = cue | ((c["kind"] == k) & before.rlike(CUES[name]))
    numbers = {
        "length": F.length(value),
        "digits": F.length(digits),
        "letters": _count(value, "[^A-Za-z]"),
        "separators": _count(value, "[^ ().-]"),
        "luhn": luhn(digits),
        "dots": _count(value, "[^.]"),
        "colons": _count(value, "[^:]"),
        "brackets": _count(value, r"[^()\[\]{}]"),
        "kind": c["kind"],
        "cue": cue,
        "other_cue": before.rlike(OTHER_CUES),
        "digit_before": before.rlike("[0-9]$"),
        "letter_before": before.rlike("[a-z]$"),
        "digit_after": after.rlike("[0-9]"),
        "letter_after": after.rlike("[A-Za-z]"),
    }
    return F.struct(*[numbers[n].cast("double").alias(n) for n in FEATURES])


def _checked(digits: str) -> str:
    """``digits`` with the last digit that makes them pass the Luhn check, in fours."""
    total = sum(int(c) if i % 2 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits)))
    whole = digits + str(-total % 10)
    return " ".join(whole[k : k + 4] for k in range(0, len(whole), 4))


def labelled(n: int = SAMPLE, seed: int = 1) -> list[tuple]:
    """(text, kind, start, end, label) of composed candidates: personal data and look-alikes."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("aeinorst") for _ in range(r.randint(3, 8)))
    hexa = lambda: "".join(r.choice("0123456789abcdef") for _ in range(4))
    dot = lambda: r.choice(["(dot)", "[dot]", "{dot}", "."])
    yes = {
        0: lambda: f"{word()} {r.choice(['(at)', '[at]', '{at}'])} {word()} {dot()} {r.choice(['com', 'org', 'net'])}",
        1: lambda: ":".join(hexa() for _ in range(8)),
        2: lambda: _checked(d(15)),
        3: lambda: r.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}"]).format(d(3), d(3), d(4)),
    }
    no = {
        0: lambda: f"{word()} (at) {d(2)}.{d(2)}",
        1: lambda: r.choice([":".join(d(2) for _ in range(8)), f"{r.randint(256, 999)}.{d(2)}.{d(2)}.{d(1)}"]),
        2: lambda: r.choice([d(r.randint(5, 22)), " ".join(d(4) for _ in range(4))]),
        3: lambda: r.choice([f"{d(3)} {d(3)} {d(4)}", f"+{d(5)}", f"+{d(20)}"]),
    }
    rows = []
    for i in range(n):
        kind, label = i % 4, (i // 4) % 2
        value = (yes if label else no)[kind]()
        cue = r.choice(CUES[KINDS[kind]].split("|")) if label else r.choice(OTHER_CUES.split("|") + [word()])
        if r.random() < 0.15:
            cue = word()
        head = f"{word()} {word()} {cue}{r.choice([' ', ': ', ' no ', ' is '])}"
        rows.append((f"{head}{value}{r.choice([' ', '. ', ', '])}{word()}", kind, len(head), len(head) + len(value), label))
    return rows


@dataclass(frozen=True)
class Model:
    """Trees as nested tuples (feature, threshold, left, right) or leaves, and thresholds."""

    trees: tuple
    weights: tuple
    thresholds: tuple

    def score(self, f: Column) -> Column:
        def walk(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(node)
            at, limit, left, right = node
            return F.when(f[FEATURES[at]] <= limit, walk(left)).otherwise(walk(right))

        margin = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights):
            margin = margin + walk(tree) * weight
        return 1 / (1 + F.exp(-2 * margin))


def _tree(node):
    """A fitted tree's nodes as plain tuples."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


@lru_cache(maxsize=4)
def fitted(sample: int = SAMPLE, precision: float = PRECISION) -> Model:
    """Boosted trees and a threshold per kind, from the labelled sample alone.

    A kind whose held-out candidates never reach the precision takes no further span.
    """
    spark = SparkSession.getActiveSession()
    rows = spark.createDataFrame(
        [(i, t, k, s, e, float(y)) for i, (t, k, s, e, y) in enumerate(labelled(sample))],
        "n int, text string, kind int, start int, end int, label double",
    )
    value = F.substr("text", F.col("start") + 1, F.col("end") - F.col("start"))
    one = F.struct("kind", "start", "end", value.alias("value"))
    wide = rows.select("n", "kind", "label", F.col("text"), one.alias("c"))
    wide = wide.select("n", "kind", "label", _features(F.col("text"), F.col("c")).alias("f"))
    wide = wide.select("n", F.col("kind").alias("k"), "label", *[F.col(f"f.{x}").alias(x) for x in FEATURES])
    wide = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(wide).coalesce(1).cache()
    learn, check = wide.where(F.col("n") % HELD_OUT != 0), wide.where(F.col("n") % HELD_OUT == 0)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1).fit(learn)
    scored = model.transform(check).select("k", "label", vector_to_array("probability")[1].alias("p")).collect()
    wide.unpersist()
    thresholds = []
    for kind in range(len(KINDS)):
        mine = sorted(((r.p, r.label) for r in scored if r.k == kind), reverse=True)
        best, right = 2.0, 0.0
        for i, (p, label) in enumerate(mine, 1):
            right += label
            if right / i >= precision and (i == len(mine) or mine[i][0] < p):
                best = p
        thresholds.append(best)
    trees = tuple(_tree(t._java_obj.rootNode()) for t in model.trees)
    return Model(trees, tuple(model.treeWeights), tuple(thresholds))


def find(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, spans array<struct<kind, base, start, end>> for every row of ``docs``.

    Spans are sorted by start, then by the order of ``KINDS``; positions are code points, ends
    exclusive. Added spans never cover a base span of their kind. Null and empty texts have
    none. Repeated rows each give theirs. Other columns of ``docs`` are not read.
    """
    text = F.col("_text")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    none = F.array().cast("array<string>")
    found = []
    for g in GENERATORS:
        hits = _matches(text, g.pattern)
        found.append(F.when(text.contains(g.needs), hits).otherwise(none) if g.needs else hits)
    rows = rows.select("*", *[m.alias(f"_m{i}") for i, m in enumerate(found)])
    placed = [_placed(text, F.col(f"_m{i}"), g) for i, g in enumerate(GENERATORS)]
    rows = rows.select("doc_id", "_text", F.concat(*placed).alias("_c"))
    known = lambda c: F.struct(*[c[x].alias(x) for x in ("kind", "start", "end", "value")],
                               (c["base"] & _valid(c)).alias("base"))
    rows = rows.select("doc_id", "_text", F.transform("_c", known).alias("_c"))
    rows = rows.select("doc_id", "_text", F.filter("_c", lambda c: c["base"]).alias("_b"), F.filter("_c", lambda c: ~c["base"]).alias("_c"))
    limit = F.array(*[F.lit(t) for t in model.thresholds])
    graded = F.transform("_c", lambda c: F.struct(c.alias("c"), _features(text, c).alias("f")))
    rows = rows.select("doc_id", "_b", graded.alias("_g"))
    chosen = F.filter("_g", lambda g: (model.score(g["f"]) >= F.get(limit, g["c"]["kind"])) & ~F.exists(
        "_b", lambda b: (b["kind"] == g["c"]["kind"]) & (b["start"] < g["c"]["end"]) & (g["c"]["start"] < b["end"])
    ))
    shape = lambda c, base: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), F.lit(base).alias("base"))
    spans = F.array_sort(F.concat(
        F.transform("_b", lambda b: shape(b, True)), F.transform(chosen, lambda g: shape(g["c"], False))
    ))
    names = F.array(*map(F.lit, KINDS))
    final = F.transform(spans, lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["base"].alias("base"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("doc_id", final.alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """Counts and hash of the base spans, and all spans as text."""
    line = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(line(base), 256).alias("base_sha256"),
        line("spans").alias("spans"),
    )
