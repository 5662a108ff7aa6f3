"""Personal data: candidate spans scored by boosted trees (operator 10, native).

Generators with high recall propose spans (anything with an @, four dotted
numbers, runs of digits with separators); base spans of the fixed kinds are
found besides and always reported.  A proposal's context and loosened format
(not the base patterns' plus sign and separators) become a few small integers.
A proposal that is a base span of its kind is a positive; one that overlaps no
base span is unlabelled: it may be personal data that the base patterns miss.
Others, such as longer versions of base spans, are not learnt from.  Both are
counted over the whole corpus by the integers: at most the product of the
features' ranges (``CELLS``) rows, whatever the corpus, are all that the
fitting sees and all that reaches the driver.  Proposals that are known to be
other numbers (ISBN check digits, dates, decimals, rows of small numbers,
reference numbers with a year) are negatives.  For each generator boosted
depth-two trees with logistic loss are fitted to these counts: positives against
unlabelled ones and against negatives, each at equal total weight.  Its threshold
is the greatest score that the wanted share of its positives reaches, raised
until the estimated precision of what is added reaches the wanted one too: the
share of known negatives above the threshold is taken for that of all unlabelled
proposals.  Proposals at or above it that overlap no base span are added.  A
few fixed examples (``SEEDS``) count with the corpus's own, so that a generator
without any base span in the corpus still has a model.

Defined cases: a null text is empty; equal rows give equal rows; other columns
are kept by ``redact`` and ignored by ``scan``; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stage
from salesmart.llm.spans import SPAN, let, matches, redacted, tagged

# The base patterns, possessive where nothing could be given
# back.  A run is tried from its beginning or from the last match's end (\G)
# only: from elsewhere it fails as it did there, and long runs stay linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

# Proposals: kind by generator, and what it takes for one.
GENERATORS = (
    ("email", r"(?:\G|(?<![^\s@<>()\[\]{},;:\"']))[^\s@<>()\[\]{},;:\"']++@[^\s@<>()\[\]{},;:\"']++"),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3,7}+"),
    ("card", r"[0-9](?:[\x20./-]{0,2}+[0-9]){11,}+"),
    ("phone", r"[+(]?+[0-9][\x20().0-9/-]{5,24}(?<=[0-9])"),
)


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Of a string of digits: every second digit from the right doubled, the
    digit sum a multiple of ten."""

    n = F.length(number)
    values = F.transform(F.split(number, ""), lambda d, i: let(
        F.coalesce(d.try_cast("int"), F.lit(0)) * F.when((n - i) % 2 == 0, 2).otherwise(1), lambda v: v - F.when(v > 9, 9).otherwise(0)
    ))
    return F.aggregate(values, F.lit(0), lambda s, x: s + x) % 10 == 0


def base_spans(text: Column) -> Column:
    """All base spans of a text, by start, then kind."""

    def card(s):
        return let(digits(s["found"]), lambda d: F.length(d).between(14, 19) & F.when(F.length(d) <= 19, passes_luhn(d)).otherwise(False))

    kinds = (
        matches(text, EMAIL),
        F.filter(matches(text, IP), lambda s: F.regexp_like(s["found"], F.lit(OCTETS))),
        F.filter(matches(text, CARD), card),
        F.filter(matches(text, PHONE), lambda s: F.length(digits(s["found"])).between(10, 15)),
    )
    return F.sort_array(F.concat(*[tagged(k, i, KINDS[i]) for i, k in enumerate(kinds)]).cast(SPAN))


# Features: name, number of values, expression of a proposal's fields.
def _bucket(n: Column, *limits: int) -> Column:
    """How many of the limits ``n`` reaches."""

    return reduce(lambda a, b: a + b, [(n >= x).cast("int") for x in limits])


def _edge(c: Column) -> Column:
    """0: nothing, white space or what stands beside a word, 1: letter or digit, 2: other."""

    return F.when(F.regexp_like(c, F.lit(r"^[\x20\x09-\x0D.,;:!?()\[\]<>{}|\"']?$")), 0).when(F.regexp_like(c, F.lit(r"[\p{L}\p{N}]")), 1).otherwise(2)


def _of(kind: str, p: Column, test: Column) -> Column:
    """The test's result, 0 for proposals of other kinds."""

    return F.when(p["generator"] == KINDS.index(kind), test.cast("int")).otherwise(0)


def _national(found: Column) -> Column:
    """Without a country code that stands apart."""

    return F.regexp_replace(found, r"^\+[0-9]{1,3}(?:[\x20.-]+|(?=\())", "")


_DATE = r"^(?:(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.]|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2})"
# Groups of a North American number (the area in brackets, or both groups from 200 on), and of
# a number in groups of two to four digits.
_NORTH_AMERICAN = r"^(?:\([0-9]{3}\)[\x20.-]*[0-9]{3}|[2-9][0-9]{2}[\x20.-]*[2-9][0-9]{2})[\x20.-]?[0-9]{4}$"
_GROUPED = r"^\(?[0-9]{1,4}\)?(?:[\x20.-][0-9]{2,4}){1,4}$"
_DECIMALS = r"^[+(]*[0-9]+\.[0-9]+(?:[\x20]+[0-9]+\.[0-9]+)+$"
_SMALL_NUMBERS = r"^[0-9]{1,2}(?:[\x20./-]+[0-9]{1,2}){5,}$"
_YEAR_REFERENCE = r"^(?:19|20)[0-9]{2}/"
_OTHER_WORD = r"(?i)(?:isbn|issn|doi|order|invoice|ref|case|file|ticket|pages?|lat|lon|gps|coord|date|version|vol|id|sku|item|model|serial)[\p{L}.:#\x20]{0,12}$"


def _is_isbn(number: Column) -> Column:
    """A 13-digit book number by its prefix and check digit."""

    weighed = F.transform(F.split(number, ""), lambda d, i: F.coalesce(d.try_cast("int"), F.lit(0)) * F.when(i % 2 == 0, 1).otherwise(3))
    return F.regexp_like(number, F.lit("^97[89][0-9]{10}$")) & (F.aggregate(weighed, F.lit(0), lambda s, x: s + x) % 10 == 0)


def _other_number(p: Column) -> Column:
    """A run of digits that is known to be something else."""

    told = reduce(lambda a, b: a | b, [F.regexp_like(p["found"], F.lit(x)) for x in (_DATE, _DECIMALS, _SMALL_NUMBERS, _YEAR_REFERENCE)])
    return (p["generator"] >= KINDS.index("card")) & F.when(F.length(p["found"]) < 60, told | _is_isbn(digits(p["found"]))).otherwise(False)


_DOMAIN = r"@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}[^\p{L}\p{N}]*$"
_HINT = "(?i)mail|phone|tel|call|mobile|fax|card|visa|iban|addr|contact|host|login"
FEATURES = (
    ("generator", 4, lambda p: p["generator"]),
    ("digits", 5, lambda p: _bucket(F.length(digits(_national(p["found"]))), 7, 10, 14, 20)),
    ("shape", 3, lambda p: _of("phone", p, let(_national(p["found"]), lambda n: F.when(F.regexp_like(n, F.lit(_NORTH_AMERICAN)), 2).otherwise(F.regexp_like(n, F.lit(_GROUPED)).cast("int"))))),
    ("dated", 2, lambda p: _of("phone", p, F.regexp_like(p["found"], F.lit(_DATE)))),
    ("luhn", 2, lambda p: _of("card", p, F.when(F.length(p["found"]) < 60, passes_luhn(digits(p["found"]))).otherwise(False))),
    ("octets", 2, lambda p: _of("ip", p, F.regexp_like(p["found"], F.lit(OCTETS)))),
    ("domain", 2, lambda p: _of("email", p, F.regexp_like(p["found"], F.lit(_DOMAIN)))),
    ("left", 3, lambda p: _edge(F.right(p["before"], F.lit(1)))),
    ("right", 3, lambda p: _edge(F.left(p["after"], F.lit(1)))),
    ("hint", 2, lambda p: F.regexp_like(p["before"], F.lit(_HINT)).cast("int")),
    ("slashed", 2, lambda p: _of("phone", p, F.regexp_like(p["found"], F.lit(r"/|[\x20().-]{3}|\.[0-9]*\x20|\x20[0-9]*\.")))),
    ("other_word", 2, lambda p: F.regexp_like(p["before"], F.lit(_OTHER_WORD)).cast("int")),
    ("other", 2, lambda p: _other_number(p).cast("int")),
)
#: A greater value never speaks against a proposal: base spans may all stand without a hint.
RISING = {"hint"}
# Positives, and numbers that are none, beside the corpus's own.
SEEDS = (
    "write to jane.doe@example.com today", "from 192.0.2.17 on", "paid with 4111 1111 1111 1111 there", "number 5500000000000004 again",
    "call +1 (212) 555-0147 now", "or +1 646-555-0199 then",
    "see 978-0-306-40615-7 there", "at 52.5200 13.4050 north", "on 2019-07-04 23 hours", "drawn 07 11 19 23 35 42 today", "as 2019/007-41234 says",
)
CELLS = 2 * math.prod(n for _, n, _ in FEATURES)


def proposals(text: Column, base: Column) -> Column:
    """Proposed spans with their features, whether each is a base span of its
    kind, and whether it is clear of all base spans."""

    def one(rank: int, pattern: str) -> Column:
        return F.transform(
            matches(text, pattern, around=24),
            lambda s: F.struct(
                F.lit(rank).alias("generator"), s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"),
                F.coalesce(s["before"], F.lit("")).alias("before"), F.coalesce(s["after"], F.lit("")).alias("after"),
            ),
        )

    def featured(p: Column, base: Column) -> Column:
        values = [f(p).cast("int").alias(name) for name, _, f in FEATURES]
        is_base = F.exists(base, lambda b: (b["start"] == p["start"]) & (b["end"] == p["end"]) & (b["rank"] == p["generator"]))
        clear = ~F.exists(base, lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"]))
        return F.struct(p["start"].alias("start"), p["end"].alias("end"), F.struct(*values).alias("x"), is_base.alias("is_base"), clear.alias("clear"))

    proposed = F.concat(*[one(i, pattern) for i, (_, pattern) in enumerate(GENERATORS)])
    # bound once a text: the optimizer may move the base spans' expression to where it is used
    return let(base, lambda b: F.transform(proposed, lambda p: featured(p, b)))


class BoostedTrees:
    """Depth-two regression trees boosted on logistic loss, fitted to counted
    cells: a feature vector with its numbers of negatives and positives."""

    def __init__(self, rounds: int = 12, rate: float = 0.5):
        self.rounds, self.rate, self.bias, self.trees = rounds, rate, 0.0, []

    def fit(self, cells: list[tuple[tuple[int, ...], float, float]]) -> BoostedTrees:
        neg, pos = sum(c[1] for c in cells), sum(c[2] for c in cells)
        self.bias = math.log((pos + 1) / (neg + 1))
        margin = [self.bias] * len(cells)
        for _ in range(self.rounds):
            g, h = [], []
            for (_, n, p), m in zip(cells, margin, strict=True):
                q = 1 / (1 + math.exp(-m))
                g.append(p - (n + p) * q)
                h.append((n + p) * q * (1 - q))
            tree = self._grow(cells, g, h, list(range(len(cells))), 2)
            self.trees.append(tree)
            margin = [m + self._leaf(tree, c[0]) for c, m in zip(cells, margin, strict=True)]
        return self

    def _grow(self, cells, g, h, rows, depth):
        gain, best = 1e-9, None
        whole = (sum(g[i] for i in rows), sum(h[i] for i in rows))
        score = lambda a, b: a * a / (b + 1)
        for f, (_, n, _) in enumerate(FEATURES) if depth else ():
            by = [[0.0, 0.0] for _ in range(n)]
            for i in rows:
                by[cells[i][0][f]][0] += g[i]
                by[cells[i][0][f]][1] += h[i]
            left = [0.0, 0.0]
            for cut in range(1, n):
                left = [left[0] + by[cut - 1][0], left[1] + by[cut - 1][1]]
                right = [whole[0] - left[0], whole[1] - left[1]]
                new = score(*left) + score(*right) - score(*whole)
                if new > gain and not (FEATURES[f][0] in RISING and right[0] / (right[1] + 1) < left[0] / (left[1] + 1)):
                    gain, best = new, (f, cut)
        if best is None:
            return max(-8.0, min(8.0, self.rate * whole[0] / (whole[1] + 1)))
        f, cut = best
        return (f, cut, self._grow(cells, g, h, [i for i in rows if cells[i][0][f] < cut], depth - 1), self._grow(cells, g, h, [i for i in rows if cells[i][0][f] >= cut], depth - 1))

    def _leaf(self, tree, x):
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] < tree[1] else tree[3]
        return tree

    def score(self, x: tuple[int, ...]) -> float:
        return 1 / (1 + math.exp(-self.bias - sum(self._leaf(t, x) for t in self.trees)))

    def column(self, x: Column) -> Column:
        """The score as an expression of the feature struct."""

        def expr(tree):
            if not isinstance(tree, tuple):
                return F.lit(tree)
            return F.when(x[FEATURES[tree[0]][0]] < tree[1], expr(tree[2])).otherwise(expr(tree[3]))

        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(lambda a, b: a + b, [F.lit(self.bias), *map(expr, self.trees)])))


Fitted = list[tuple[BoostedTrees, float]]


def calibrate(cells: list[tuple[tuple[int, ...], float, float, float]], recall: float, precision: float = 0.9) -> tuple[BoostedTrees, float]:
    """Model and threshold of a generator's cells: a feature vector with its
    numbers of unlabelled proposals, known negatives and positives."""

    unlabelled, negative, positive = (sum(c[k] for c in cells) for k in (1, 2, 3))
    weight = lambda n, total: n * positive / total if n else 0.0
    model = BoostedTrees().fit([(x, weight(u, unlabelled) + weight(n, negative), p) for x, u, n, p in cells])
    scored = sorted(((model.score(x), u, n, p) for x, u, n, p in cells), reverse=True)
    limit, reached = 2.0, 0.0
    for score, _, _, p in scored:
        if reached >= recall * positive:
            break
        if p:
            limit, reached = score, reached + p
    for score in sorted({s[0] for s in scored if s[0] >= limit}):
        added = sum(u for s, u, _, _ in scored if s >= score)
        wrong = sum(n for s, _, n, _ in scored if s >= score) / max(negative, 1.0) * unlabelled
        if wrong <= (1 - precision) * added:
            return model, score
    return model, 2.0


def fit(found: DataFrame, recall: float = 0.95, precision: float = 0.9) -> Fitted:
    """Model and threshold of each generator."""

    names = [f"p.x.{name}" for name, _, _ in FEATURES]
    seeds = _found(found.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, SEEDS))).alias("_text")))
    each = found.select("_proposed").unionByName(seeds.select("_proposed")).select(F.explode("_proposed").alias("p"))
    counted = each.filter("p.is_base or p.clear").groupBy(*[F.col(n).alias(n.rsplit(".", 1)[1]) for n in names]).agg(
        F.count_if(~F.col("p.is_base")).alias("clear"), F.count_if(F.col("p.is_base")).alias("positive")
    )
    cells = []
    for r in counted.collect():
        clear, known = float(r["clear"]), bool(r["other"])
        cells.append((tuple(r[: len(names)]), 0.0 if known else clear, clear if known else 0.0, float(r["positive"])))
    return [calibrate(sorted(c for c in cells if c[0][0] == k), recall, precision) for k in range(len(GENERATORS))]


def _found(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` spans and ``_proposed`` ones of the column ``_text``."""

    some = F.regexp_like("_text", F.lit("[0-9@]"))  # without digit or @ there is nothing to find
    nothing = proposals(F.lit(""), F.array().cast(SPAN))
    docs = docs.withColumn("_base", F.when(some, base_spans(F.col("_text"))).otherwise(F.array().cast(SPAN)))
    return docs.withColumn("_proposed", F.when(some, proposals(F.col("_text"), F.col("_base"))).otherwise(nothing))


def _spans(fitted: Fitted) -> Column:
    """Base spans and the proposals that the models select."""

    def selected(p: Column) -> Column:
        # the sums of the same leaves may differ in their last digits from the driver's
        each = [(p["x"]["generator"] == k) & (model.column(p["x"]) >= limit - 1e-9) for k, (model, limit) in enumerate(fitted)]
        return p["clear"] & reduce(lambda a, b: a | b, each)

    chosen = F.filter("_proposed", selected)
    added = F.transform(
        chosen,
        lambda p: F.struct(
            p["start"].alias("start"), p["x"]["generator"].alias("rank"), p["end"].alias("end"),
            F.element_at(F.array(*[F.lit(k) for k, _ in GENERATORS]), p["x"]["generator"] + 1).alias("kind"),
        ),
    )
    return F.sort_array(F.array_union(F.col("_base"), added.cast(SPAN)))


def _text(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`"), F.lit(""))


def scan(docs: DataFrame, text: str = "text", recall: float = 0.95, precision: float = 0.9) -> DataFrame:
    """doc_id, base and spans (arrays of start, rank, end, kind), one row per document."""

    found = stage(_found(docs.select("doc_id", _text(text).alias("_text"))).drop("_text"), "pii-candidates")
    return found.select("doc_id", F.col("_base").alias("base"), _spans(fit(found, recall, precision)).alias("spans"))


def redact(docs: DataFrame, recall: float = 0.95, precision: float = 0.9) -> DataFrame:
    """``docs`` with all spans of ``text`` replaced by their kind, and
    ``n_chars``, where there is such a column, by the new length.

    The model is fitted to the counts of one pass; a second one finds and
    replaces the spans row by row, so no text is shuffled."""

    # staged, so that the proposals are made once a text and not once a counted feature
    fitted = fit(stage(_found(docs.select(_text("text").alias("_text"))).select("_proposed"), "pii-proposals"), recall, precision)
    out = _found(docs.withColumn("_text", _text("text"))).withColumn("_spans", _spans(fitted))
    found = F.size("_spans") > 0
    out = out.withColumn("text", F.when(found, redacted(F.col("text"), F.col("_spans"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(found, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[f"`{c}`" for c in docs.columns])
