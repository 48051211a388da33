"""Personal data by patterns and a semi-Markov conditional random field.

Four base kinds follow fixed patterns and always stay. Around every digit or ``@`` the
field then scores whole segments: each candidate segment of up to ``MOST_TOKENS`` tokens
and each kind get a score from features of the entire segment (its pattern, number
of digits, borders), and dynamic programming over segment ends chooses boundaries and
kinds together. Segments of posterior ``SURE`` or more that touch no base span are added:
personal data that is written in other ways than the base patterns take, as a card number with dots between its groups, a
telephone number without its plus or an address with blanks around its ``@``.

The field is trained by conditional likelihood on the base spans of at most ``SAMPLE``
documents, those with the least hash of their id: a bounded sample, wherever the data. Of
their zones of at most 60 tokens, at most ``ZONES_OF_A_KIND`` of each kind and ``ZONES_WITHOUT`` without a
span are learned from; longer zones are searched but not learned from. Each span is also learned in the other ways of
writing that ``VARIANTS`` has, at its place, and one of its numbers alone there as no span, so the field learns its kind from what
is around it and from the size and number of its parts. It adds nothing if the sample has no spans.

Scale: one scan, no shuffle; all texts are searched whole, in linear time. Decoding
depends on the shapes of tokens only and is remembered per task for a bounded number of shapes. The passes over a zone hold some
numbers per token and the scores of a bounded number of segments, so a text of nothing but numbers costs no more memory than others.

Null and empty texts have no spans. Repeated rows get equal results. Other columns of
the table, whatever their names, are kept by ``find_spans`` and ``mask``.
"""

from __future__ import annotations

import math
import re
from array import array

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.storage import stored

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 4000  # documents
ZONES_OF_A_KIND, ZONES_WITHOUT = 150, 600  # of those
MOST_TOKENS = 20
SURE = 0.8
EPOCHS, RATE, DECAY = 4, 0.5, 1e-4
REMEMBERED = 5_000  # zones
SEGMENTS = 20_000  # whose scores are remembered
FOUND = "_personal_spans"

# The base patterns. Runs are possessive, which changes no match.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_DIGITS = re.compile("[0-9]+")
_NOT_DIGIT = re.compile("[^0-9]")


def _in_fours(value: str, mark: str) -> str:
    return mark.join(re.findall("[0-9]{1,4}", _NOT_DIGIT.sub("", value)))


# Other ways of writing a kind.
VARIANTS = {
    "email": (lambda v: v.replace("@", " @ "), lambda v: v.replace("@", " [@] ")),
    "ip": (lambda v: v.replace(".", " . "), lambda v: v.replace(".", ". ")),
    "card": (lambda v: _in_fours(v, "."), lambda v: _in_fours(v, "/")),
    "phone": (lambda v: v[1:], lambda v: "00" + v[1:], lambda v: re.sub("[ -]", "/", v)),
}

FOLLOWING = " 192.168.7.21"  # a span of another kind right behind one, which the base patterns may take in and fail

_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\S\n]+|\n|.", re.S)
_MARK = re.compile(r"[0-9@]")
_RUN = re.compile(r"\S*")


def _emails(text: str):
    behind = 0
    for m in _DOMAIN.finditer(text):
        at = first = m.start()
        while first > behind and text[first - 1] in _LOCAL:
            first -= 1
        if first < at:
            behind = m.end()
            yield first, behind


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) << (place & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed kinds, by start, then kind."""
    spans = []
    if "@" in text:
        spans += [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


# --- the field ------------------------------------------------------------------------


def _places(text: str):
    """Spans of neighbouring words with a digit or @, at most three characters apart and on one line."""
    first, behind = None, 0
    while m := _MARK.search(text, behind):
        start, end = m.start(), _RUN.match(text, m.start()).end()
        while start > behind and not text[start - 1].isspace():
            start -= 1
        if first is not None and not (start - behind <= 3 and "\n" not in text[behind:start]):
            yield first, behind
            first = None
        first, behind = start if first is None else first, end
    if first is not None:
        yield first, behind


def zones(text: str):
    """Starts of the tokens, and the end of the last, of each place where personal data may be, with the words beside it."""
    for first, last in _places(text):
        left = text.rfind(" ", max(0, first - 40), max(0, first - 1)) + 1 or max(0, first - 1)
        right = text.find(" ", last + 1, last + 40)
        right = right if right >= 0 else min(len(text), last + 1)
        starts = array("q", (t.start() for t in _TOKEN.finditer(text, left, right)))
        starts.append(right)
        yield starts


def token_shape(token: str) -> str:
    """What the field sees of a token: digits by their number, a word as such, else the character."""
    first = token[0]
    if "0" <= first <= "9":
        return f"9{len(token)}"
    if first.isascii() and first.isalpha():
        return "a"
    return " " if first.isspace() else first if first.isascii() else "w"


def segment_features(shapes: tuple[str, ...], first: int, last: int) -> list[str]:
    """Features of the whole segment of tokens ``first`` to ``last`` (exclusive)."""
    own = shapes[first:last]
    digits = sum(int(s[1:]) for s in own if s[0] == "9")
    plain = "".join(s[0] for s in own)
    before = shapes[first - 1][0] if first else "^"
    after = shapes[last][0] if last < len(shapes) else "$"
    marks = "".join(sorted(set(plain)))
    found = [
        "bias", f"plain={plain}", f"digits={min(digits, 25)}", f"marks={marks}", f"before={before}", f"after={after}",
        f"in={plain[0]}{plain[-1]}", f"n={last - first}",
    ]
    if plain.count(".") <= 8:
        found.append(f"dots={plain.count('.')},{'@' in plain}")
    if len(own) <= 10:
        found.append("full=" + ",".join(own))
    return found


def _segments(shapes: tuple[str, ...]) -> list[tuple[int, int, list[str]]]:
    """Segments that may be an entity: they hold a digit or @ and end with a word or number."""
    found = []
    for i in range(len(shapes)):
        if shapes[i][0] in " \n":
            continue
        useful = False
        for j in range(i + 1, min(len(shapes), i + MOST_TOKENS) + 1):
            s = shapes[j - 1][0]
            if s == "\n":
                break
            useful |= s in "9@"
            if useful and s in "9a":
                found.append((i, j, segment_features(shapes, i, j)))
    return found


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


class Field:
    """Weights by (kind, feature). A token outside entities scores 0."""

    def __init__(self):
        self.weights: dict[str, list[float]] = {}
        self.squares: dict[str, list[float]] = {}
        self.known: dict[tuple, tuple] = {}

    def scores(self, features: list[str]) -> list[float]:
        total = [0.0] * len(KINDS)
        for f in features:
            if w := self.weights.get(f):
                for k, x in enumerate(w):
                    total[k] += x
        return total

    def posteriors(self, shapes: tuple[str, ...], segments) -> tuple[list[list[float]], list[list[float]]]:
        """Of each segment, scores and posteriors by kind: sums over all segmentations."""
        n = len(shapes)
        scored = [self.scores(f) for _, _, f in segments]
        ends, starts = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
        for s, (i, j, _) in enumerate(segments):
            whole = _log_sum(scored[s])
            ends[j].append((i, whole))
            starts[i].append((j, whole))
        up, down = [0.0] * (n + 1), [0.0] * (n + 1)
        for p in range(1, n + 1):
            up[p] = _log_sum([up[p - 1], *[up[i] + x for i, x in ends[p]]])
        for p in range(n - 1, -1, -1):
            down[p] = _log_sum([down[p + 1], *[down[j] + x for j, x in starts[p]]])
        total = up[n]
        return scored, [
            [math.exp(up[i] + x + down[j] - total) for x in scored[s]] for s, (i, j, _) in enumerate(segments)
        ]

    def learn(self, shapes: tuple[str, ...], gold: set[tuple[int, int, int]]) -> None:
        """One step up the gradient of the log likelihood of the gold segments."""
        segments = _segments(shapes)
        if not segments:
            return
        _, posteriors = self.posteriors(shapes, segments)
        for (i, j, features), p in zip(segments, posteriors, strict=True):
            for k in range(len(KINDS)):
                slope = ((i, j, k) in gold) - p[k]
                if abs(slope) < 1e-3:
                    continue
                for f in features:
                    w = self.weights.setdefault(f, [-4.0 if f == "bias" else 0.0] * len(KINDS))
                    q = self.squares.setdefault(f, [1e-2] * len(KINDS))
                    q[k] += slope * slope
                    w[k] += RATE * slope / math.sqrt(q[k]) - DECAY * w[k]

    def segment_scores(self, shapes: tuple[str, ...], first: int, last: int) -> tuple[list[float], float, int]:
        """Scores by kind of a segment, the logarithm of their sum, and the best kind."""
        key = shapes[max(0, first - 1) : last + 1], first == 0, last == len(shapes)
        found = self.known.get(key)
        if found is None:
            scores = self.scores(segment_features(shapes, first, last))
            found = scores, _log_sum(scores), max(range(len(KINDS)), key=scores.__getitem__)
            if len(self.known) < SEGMENTS:
                self.known[key] = found
        return found

    def decode(self, shapes: tuple[str, ...]) -> list[tuple[int, int, int, float]]:
        """Best segmentation: (first token, behind the last, kind, posterior) of its entities.

        One pass forward and, if it finds any, one backward for the posteriors; scores are worked out in a window.
        """
        n = len(shapes)
        opens = array("i", [0]) * (n + 1)  # behind the last line end before a place
        useful = array("i", [-1]) * (n + 1)  # last digits or @ before a place
        for p in range(n):
            c = shapes[p][0]
            opens[p + 1] = p + 1 if c == "\n" else opens[p]
            useful[p + 1] = p if c in "9@" else useful[p]

        def firsts(p: int):
            """Where segments that end before ``p`` may begin."""
            if shapes[p - 1][0] in "9a":
                for i in range(max(opens[p], p - MOST_TOKENS), min(p, useful[p] + 1)):
                    if shapes[i][0] not in " \n":
                        yield i

        up, best = array("d", [0.0]) * (n + 1), array("d", [0.0]) * (n + 1)
        back, kinds = array("i", [-1]) * (n + 1), array("b", [0]) * (n + 1)
        for p in range(1, n + 1):
            sums, top = [up[p - 1]], best[p - 1]
            for i in firsts(p):
                scores, whole, k = self.segment_scores(shapes, i, p)
                sums.append(up[i] + whole)
                if best[i] + scores[k] > top:
                    top, back[p], kinds[p] = best[i] + scores[k], i, k
            best[p] = top
            up[p] = _log_sum(sums) if len(sums) > 1 else sums[0]
        found, p = [], n
        while p:
            if back[p] < 0:
                p -= 1
            else:
                found.append((back[p], p, kinds[p]))
                p = back[p]
        if not found:
            return []
        down = array("d", [-math.inf]) * (n + 1)
        down[n] = 0.0
        for p in range(n, 0, -1):  # all that leads to p is known
            down[p - 1] = _log_sum([down[p - 1], down[p]])
            for i in firsts(p):
                down[i] = _log_sum([down[i], down[p] + self.segment_scores(shapes, i, p)[1]])
        return [
            (i, j, k, math.exp(up[i] + self.segment_scores(shapes, i, j)[0][k] + down[j] - up[n])) for i, j, k in reversed(found)
        ]


def _shapes(text: str, starts: array) -> tuple[str, ...]:
    return tuple(token_shape(text[a:b]) for a, b in zip(starts, starts[1:]))


def zone_examples(text: str) -> list[tuple[tuple[str, ...], set[tuple[int, int, int]]]]:
    """Shapes of each zone with its base spans in tokens."""
    spans, found = base_spans(text), []
    for starts in zones(text):
        places = {a: i for i, a in enumerate(starts)}
        gold = {(places[a], places[b], KINDS.index(k)) for k, a, b in spans if a in places and b in places}
        clear, behind = set(), -1
        for g in sorted(gold):  # where base kinds overlap, the first one counts
            if g[0] >= behind:
                clear.add(g)
                behind = g[1]
        found.append((_shapes(text, starts), clear))
    return found


def variant_examples(text: str) -> list[tuple[tuple[str, ...], set[tuple[int, int, int]]]]:
    """Zones of the base spans in the other ways of writing, with the span that is then no base span."""
    found = []
    for kind, a, b in base_spans(text):
        single = _DIGITS.findall(text[a:b])[-1:]  # a number of its own is no span
        for value, behind in (*((other(text[a:b]), "") for other in VARIANTS[kind]), *((v, "") for v in single), (text[a:b], FOLLOWING)):
            near = text[max(0, a - 60) : a] + value + behind + text[b : b + 60]
            first = min(a, 60)
            if any(x < first + len(value) and first < y for _, x, y in base_spans(near)):
                continue
            for starts in zones(near):
                places = {x: i for i, x in enumerate(starts)}
                if first in places and first + len(value) in places:
                    spans = {(places[first], places[first + len(value)], KINDS.index(kind))}
                    if behind:
                        spans.add((places[first + len(value) + 1], places[first + len(value + behind)], KINDS.index("ip")))
                    found.append((_shapes(near, starts), set() if [value] == single else spans))
    return found


def train(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """Fit the field on the base spans of at most ``sample`` documents."""
    order = F.xxhash64("doc_id")
    chosen = docs.select("doc_id").filter(F.col("doc_id").isNotNull()).orderBy(order, "doc_id").limit(sample)
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen.distinct()), "doc_id", "left_semi")

    def examples(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                for number, (shapes, gold) in enumerate([*zone_examples(text or ""), *variant_examples(text or "")]):
                    if len(shapes) <= 60:
                        kind = min((k for _, _, k in gold), default=len(KINDS))
                        rows.append((doc_id, number, kind, list(shapes), [list(g) for g in sorted(gold)]))
            yield pd.DataFrame(rows, columns=["doc_id", "number", "kind", "shapes", "gold"])

    found = picked.mapInPandas(
        examples, "doc_id bigint, number int, kind int, shapes array<string>, gold array<array<int>>"
    )
    found = stored(found)
    # a bounded number of each kind reaches the driver
    parts = [
        found.filter(F.col("kind") == k).orderBy(F.xxhash64("doc_id", "number"), "doc_id", "number")
        .limit(ZONES_OF_A_KIND * (1 + len(VARIANTS[KINDS[k]])) if k < len(KINDS) else ZONES_WITHOUT)
        for k in range(len(KINDS) + 1)
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    rows = sorted(whole.collect(), key=lambda r: (r.number, r.doc_id))
    field = Field()
    if any(r.gold for r in rows):
        for _ in range(EPOCHS):
            for r in rows:
                field.learn(tuple(r.shapes), {tuple(g) for g in r.gold})
    return field


def added_spans(text: str, base: list[tuple[str, int, int]], field: Field, memory: dict) -> list[tuple[str, int, int]]:
    """Sure entities of the field that touch no base span."""
    if not field.weights:
        return []
    added = []
    for starts in zones(text):
        shapes = _shapes(text, starts)
        found = memory.get(shapes)
        if found is None:
            found = field.decode(shapes)
            if len(memory) < REMEMBERED and len(shapes) < 200:
                memory[shapes] = found
        for i, j, kind, sure in found:
            a, b = starts[i], starts[j]
            if sure >= SURE and not any(a < y and x < b for _, x, y in base):
                added.append((KINDS[kind], a, b))
    return added


def _searcher(field: Field):
    """A function that gives the base spans and the added ones of a text, and remembers what it has decoded."""
    memory: dict = {}

    def search(text: str | None) -> tuple[list, list]:
        base = base_spans(text) if text else []
        return base, added_spans(text, base, field, memory) if text else []

    return search


def _shared(docs: DataFrame, field: Field):
    shared = docs.sparkSession.sparkContext.broadcast(field.weights)

    def searcher():
        own = Field()
        own.weights = shared.value
        return _searcher(own)

    return searcher


def find_spans(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with the column ``FOUND``: arrays of base spans and of added ones (kind, start, end in code points)."""
    searcher = _shared(docs, field)
    span = "array<struct<kind:string,start:bigint,end:bigint>>"

    @F.pandas_udf(f"struct<base:{span},added:{span}>")
    def find(texts: pd.Series) -> pd.DataFrame:
        search, keys = searcher(), ("kind", "start", "end")
        rows = [[[dict(zip(keys, s, strict=True)) for s in x] for x in search(text)] for text in texts]
        return pd.DataFrame(rows, columns=["base", "added"])

    return docs.withColumn(FOUND, find.asNondeterministic()(F.col("text")))


def _listed(spans) -> F.Column:
    """kind:start:end by start, then kind in the fixed order."""
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("a"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("e"), s["kind"].alias("n")),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["n"], s["a"], s["e"])), ",")


def _number_of(kind: str) -> F.Column:
    return F.size(F.filter(f"{FOUND}.base", lambda s: s["kind"] == kind))


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, their digest and all spans of each document."""
    found = find_spans(docs.select("doc_id", "text"), train(docs))
    return found.select(
        "doc_id",
        *[_number_of(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(F.col(f"{FOUND}.base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat(f"{FOUND}.base", f"{FOUND}.added")).alias("spans"),
        F.size(f"{FOUND}.added").cast("bigint").alias("n_added"),
    )


def masked(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with ``<KIND>`` for every span; overlapping ones become the first's."""
    if text is None or not spans:
        return text
    pieces, behind = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if start >= behind:
            pieces += [text[behind:start], f"<{kind.upper()}>"]
        behind = max(behind, end)
    return "".join([*pieces, text[behind:]])


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """Every span, base or added, becomes ``<KIND>`` in ``text``; overlapping ones become the first's.

    ``n_chars``, where there is one, follows the text.
    """
    columns, searcher = docs.columns, _shared(docs, field)

    @F.pandas_udf("string")
    def replaced(texts: pd.Series) -> pd.Series:
        search = searcher()
        return pd.Series([masked(text, [s for x in search(text) for s in x]) for text in texts], dtype=object)

    done = docs.withColumn("text", replaced.asNondeterministic()("text"))
    if "n_chars" in columns:
        done = done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*[F.col(f"`{c}`") for c in columns])
