"""Personal data: exact base patterns, and spans that a conditional random field adds.

The field's tokens are words, numbers and single signs; its features are their shapes, a
few key words and those of the neighbours.  It is trained from a small labelled table (``text, spans``)
and decodes, in batches, the stretches around digits, at-signs and the words ``at`` and ``dot``: what a span of
the four kinds looks like holds one of these.  A stretch ends between words, and grows while a span touches its edge.  A span of the field that meets a base span is left out.

Edge cases: null and empty texts have no spans; texts are read whole, and every search is linear
in their length; repeated rows are searched each; an empty table gives no rows; extra columns are
returned by ``masked`` as they are and read by nothing, whatever their names.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passagerank.llm import crf
from passagerank.llm.shared import text_of

#: The kinds, in the order that breaks ties.
KINDS = ("email", "ip", "card", "phone")
#: Characters around an anchor, tokens decoded at a time and read before and after them, stretches of a batch.
AROUND, CHUNK, BEFORE, AFTER, BATCH = 48, 192, 24, 80, 256

LOCAL = "".join(map(chr, (*range(48, 58), *range(65, 91), *range(97, 123)))) + "._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
ANCHOR = re.compile(r"[0-9@]|(?<![^\W\d_])(?:[Aa][Tt]|[Dd][Oo][Tt])(?![^\W\d_])")
UNBROKEN = re.compile(r"\S*+")
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    floor, at = 0, text.find("@")
    while at >= 0:
        start = floor + len(text[floor:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield ("email", start, domain.end())
        floor = domain.end() if domain else at + 1
        at = text.find("@", floor)


def _addresses(text: str) -> Iterator[Span]:
    for chain in CHAIN.finditer(text):
        parts = chain.group().split(".")
        if len(parts) < 4:
            continue
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield ("ip", at, end)
            at = end + 1


def _cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = re.sub("[ -]", "", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield ("card", m.start(), m.end())


def _phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if 10 <= len(DIGIT.findall(m.group())) <= 15:
            yield ("phone", m.start(), m.end())


def base_spans(text: str) -> list[Span]:
    """The exact patterns, leftmost and without overlaps per kind."""
    found = list(_emails(text)) if "@" in text else []
    if DIGIT.search(text):
        found += [*_addresses(text), *_cards(text), *_phones(text)]
    return sorted(found, key=place)


def place(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


KEYWORDS = {
    "at", "dot", "com", "org", "net", "example", "mail", "email", "e", "phone", "tel", "telephone", "call", "mobile",
    "fax", "card", "visa", "credit", "ip", "host", "server", "address", "version", "v", "isbn", "order", "ext",
}


def shape(token: str) -> str:
    """Lengths of digit runs, case and length class of words, signs themselves."""
    if token[0].isdigit():
        return f"d{min(len(token), 20)}"
    if token.isalpha():
        case = "X" if token.isupper() else "Xx" if token[0].isupper() else "x"
        return case + ("1" if len(token) == 1 else "3" if len(token) <= 3 else "n")
    return token


def features_of(tokens: list[str], glued: list[bool]) -> list[list[str]]:
    """Feature names of every token; ``glued`` says that no space stands before it."""
    shapes = ["^", *map(shape, tokens), "$", "$"]
    low = [t.lower() for t in tokens]
    keys = ["", "", *[w if w in KEYWORDS else "" for w in low], "", "", ""]
    out = []
    for i in range(len(tokens)):
        joint = ("+" if glued[i] else " ") + ("+" if i + 1 < len(tokens) and glued[i + 1] else " ")
        here, before, after, later = shapes[i + 1], shapes[i], shapes[i + 2], shapes[min(i + 3, len(shapes) - 1)]
        out.append([
            "bias", f"s={here}", f"s-={before}", f"s+={after}", f"s-s={before}|{here}|{joint[0]}",
            f"ss+={here}|{after}|{joint[1]}", f"-s+={before}|{here}|{after}|{joint}", f"s++={after}|{later}",
            f"j={joint}", f"k={keys[i + 2]}", f"k-={keys[i + 1]}", f"k+={keys[i + 3]}", f"k--={keys[i]}", f"k++={keys[i + 4]}",
            f"k-+={keys[i + 1]}|{keys[i + 3]}",
        ])
    return out


LABELS = ["O", *[f"{p}-{k}" for k in KINDS for p in "BI"]]


def _rules() -> tuple[np.ndarray, np.ndarray]:
    """Which label may follow which, and which may come first."""
    allowed = np.array([[b[0] != "I" or (a != "O" and a[2:] == b[2:]) for b in LABELS] for a in LABELS])
    return allowed, np.array([label[0] != "I" for label in LABELS])


def _tokens(text: str, start: int = 0, end: int | None = None) -> list[re.Match]:
    return list(TOKEN.finditer(text, start, len(text) if end is None else end))


def _glued(found: list[re.Match]) -> list[bool]:
    return [i > 0 and found[i - 1].end() == m.start() for i, m in enumerate(found)]


def train_field(labelled: DataFrame, most: int = 2_000) -> crf.Field:
    """The field learned from ``text, spans`` rows (``spans``: structs of kind, start, end).

    It is fitted on ``most`` rows at most, chosen by a hash of the text, so that reruns agree.
    """
    rows = labelled.select("text", "spans").orderBy(F.xxhash64("text"), "text").limit(most).collect()
    sequences, labels = [], []
    for row in rows:
        found = _tokens(row["text"])
        if not found:
            continue
        of = [0] * len(found)
        for kind, start, end in row["spans"]:
            inside = [i for i, m in enumerate(found) if m.start() >= start and m.end() <= end]
            for n, i in enumerate(inside):
                of[i] = LABELS.index(("B-" if n == 0 else "I-") + kind)
        sequences.append(features_of([m.group() for m in found], _glued(found)))
        labels.append(of)
    return crf.train(sequences, labels, len(LABELS), *_rules())


#: What a span of the field must look like, disguises included.
SURFACES = {
    "email": re.compile(
        r"[\w.%+-]+\s?(?:@|[\[(]?(?:at|AT|At)[\])]?)\s?[\w-]+(?:\s?(?:\.|[\[(]?(?:dot|DOT|Dot)[\])]?)\s?[\w-]+)+"
    ),
    "ip": re.compile(r"[0-9]{1,3}(?:\s?[\[(]?\.[\])]?\s?[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9](?:[ .-]{0,3}[0-9])+"),
    "phone": re.compile(r"[+(]?[0-9](?:[ ().+-]{0,3}[0-9])+"),
}


def _plausible(kind: str, text: str) -> bool:
    """Guards on what the field finds: a number of the right length is not yet a card."""
    if not SURFACES[kind].fullmatch(text):
        return False
    digits = "".join(DIGIT.findall(text))
    if kind == "ip":
        return all(int(part) <= 255 for part in re.findall("[0-9]+", text))
    return {"email": True, "card": 14 <= len(digits) <= 19 and luhn(digits or "1"), "phone": 9 <= len(digits) <= 15}[kind]


def _word_start(text: str, at: int, floor: int) -> int:
    while at > floor and not text[at - 1].isspace():
        at -= 1
    return at


def _word_end(text: str, at: int) -> int:
    return UNBROKEN.match(text, min(at, len(text))).end()


def _stretches(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around anchors, with whole words at their ends."""
    start = end = -1
    for m in ANCHOR.finditer(text):
        if m.start() - AROUND > end >= 0:
            end = _word_end(text, end)
        if m.start() - AROUND > end:
            if end >= 0:
                yield start, end
            start = _word_start(text, max(0, m.start() - AROUND), max(0, end))
        end = max(end, m.end() + AROUND)
    if end >= 0:
        yield start, _word_end(text, end)


class Finder:
    def __init__(self, field: crf.Field):
        self.field = field

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """Spans of the field for every text, beside its base spans."""
        out: list[list[Span]] = [[] for _ in texts]
        stretches, around = [(i, *s) for i, text in enumerate(texts) for s in _stretches(text)], AROUND
        while stretches:
            touched = self._decode(texts, stretches, out)
            # a stretch that a span may run out of is decoded again with more text around it
            stretches = [
                (i, _word_start(texts[i], max(0, start - around), 0), _word_end(texts[i], end + around))
                for i, start, end in touched
            ]
            around *= 2
        return [self._beside(spans, kept) for spans, kept in zip(out, base, strict=True)]

    def _decode(self, texts: list[str], stretches: list[tuple[int, int, int]], out: list[list[Span]]) -> list:
        """Adds the spans of the stretches to ``out``; returns instead stretches with a span at an edge inside the text."""
        pieces = []  # stretch, tokens, first and last token whose labels count, whether these are the first and last of all
        for n, (i, start, end) in enumerate(stretches):
            found = _tokens(texts[i], start, end)
            glued = _glued(found)
            for at in range(0, len(found), CHUNK):
                low, high = max(0, at - BEFORE), min(len(found), at + CHUNK + AFTER)
                stop = min(at + CHUNK, len(found))
                edges = (at == 0 and start > 0, stop == len(found) and end < len(texts[i]))
                pieces.append((n, found[low:high], glued[low:high], at - low, stop - low, edges))
        pieces.sort(key=lambda p: len(p[1]))
        spans: list[list[Span]] = [[] for _ in stretches]
        unended: list[list[int]] = [[] for _ in stretches]
        touched = set()
        for at in range(0, len(pieces), BATCH):
            held = pieces[at : at + BATCH]
            scores = [self.field.emissions(features_of([m.group() for m in p[1]], p[2])) for p in held]
            for (n, found, _, first, last, edges), labels in zip(
                held, crf.viterbi(scores, self.field.steps, self.field.starts), strict=True
            ):
                kept, open_ = self._spans(found, labels.tolist(), first, last, texts[stretches[n][0]])
                spans[n] += kept
                unended[n] += open_
                if any((edges[0] and s == found[first].start()) or (edges[1] and e >= found[last - 1].end()) for _, s, e in kept):
                    touched.add(n)
        for n, (i, _, end) in enumerate(stretches):
            floor = -1
            for start in sorted(unended[n]):
                # an address that its piece does not end: read on in the stretch, each part of it once
                if start >= floor and (whole := SURFACES["email"].match(texts[i], start, end)):
                    floor = whole.end()
                    spans[n].append(("email", start, floor))
                    if floor >= end < len(texts[i]):
                        touched.add(n)
            if n not in touched:
                out[i] += spans[n]
        return [stretches[n] for n in sorted(touched)]

    @staticmethod
    def _spans(found, labels, first, last, text) -> tuple[list[Span], list[int]]:
        """Spans that begin at the tokens from ``first`` to ``last``, and where addresses begin that the tokens do not end.

        Numbers of the greatest length, with separators, end within ``AFTER`` tokens.
        """
        spans, unended, i = [], [], first
        while i < last:
            label = LABELS[labels[i]]
            i += 1
            if label[0] != "B":
                continue
            start, end = found[i - 1].start(), found[i - 1].end()
            while i < len(found) and LABELS[labels[i]] == "I-" + label[2:]:
                end = found[i].end()
                i += 1
            if label == "B-email" and i == len(found) > last:
                unended.append(start)
                continue
            if label == "B-email" and (whole := SURFACES["email"].match(text, start, end)):
                # labels may run on into the words after an address
                end = whole.end()
            if _plausible(label[2:], text[start:end]):
                spans.append((label[2:], start, end))
        return spans, unended

    @staticmethod
    def _beside(spans: list[Span], kept: list[Span]) -> list[Span]:
        """Spans that meet no base span (of any kind), sorted and without repeats."""
        out, held, at, reach, floor = [], sorted(s for _, *s in kept), 0, -1, -1
        for span in sorted(set(spans), key=place):
            # base spans that begin before this one, and how far they reach
            while at < len(held) and held[at][0] < span[1]:
                reach = max(reach, held[at][1])
                at += 1
            meets = reach > span[1] or (at < len(held) and held[at][0] < span[2])
            if not meets and floor <= span[1]:
                out.append(span)
                floor = span[2]
        return out


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find_spans(docs: DataFrame, field: crf.Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, spans``: all spans in code points, by start and kind; ``base`` marks exact ones."""
    shipped = docs.sparkSession.sparkContext.broadcast((field.features, field.weights, field.steps, field.starts))
    struct = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(crf.Field(*shipped.value))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            base = [base_spans(t) for t in texts]
            every = []
            for kept, more in zip(base, finder.added(texts, base), strict=True):
                both = [(*s, True) for s in kept] + [(*s, False) for s in more]
                every.append([dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in sorted(both, key=place)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(every, pa.list_(struct))], ["doc_id", "text", "spans"]
            )

    columns = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = columns.schema["doc_id"].dataType.simpleString()
    return columns.mapInArrow(run, f"doc_id {kind}, text string, spans {SPANS}")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def mask_text(text: str, spans: list[Span]) -> str:
    """The text with every span (overlapping ones as one) replaced by its kind in brackets."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=place):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def masked(docs: DataFrame, field: crf.Field, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` masked; other columns stay, a null text too."""
    shipped = docs.sparkSession.sparkContext.broadcast((field.features, field.weights, field.steps, field.starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(crf.Field(*shipped.value))
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            base = [base_spans(t) for t in texts]
            new = [mask_text(t, b + a) for t, b, a in zip(texts, base, finder.added(texts, base), strict=True)]
            valid = batch.column(text).is_valid().to_pylist()
            column = pa.array([n if v else None for n, v in zip(new, valid, strict=True)], pa.string())
            at = batch.schema.get_field_index(text)
            columns = [column if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def labelled_examples(spark: SparkSession, n: int = 1600, seed: int = 5) -> DataFrame:
    """A small labelled table ``text, spans``: personal data in usual and disguised forms among other numbers."""
    return spark.createDataFrame(examples(n, seed), "text string, spans array<struct<kind:string,start:int,end:int>>")


def examples(n: int, seed: int) -> list[tuple[str, list[Span]]]:
    draw = random.Random(seed)

    def word(least: int = 2, most: int = 9) -> str:
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(least, most)))

    def digits(count: int) -> str:
        return "".join(draw.choice("0123456789") for _ in range(count))

    def email() -> str:
        name, host, top = word(3), word(3), draw.choice(("com", "org", "net", "de", "fr", "es"))
        if draw.random() < 0.4:
            name += draw.choice(("", ".", "_", "-")) + draw.choice((word(), digits(2)))
        at = draw.choice(("@", "@", " at ", " at ", " (at) ", "(at)", " [at] ", " @ ", "[at]", " AT "))
        dot = "." if at == "@" else draw.choice((".", ".", ".", " dot ", " (dot) ", " [dot] ", "[dot]", "(dot)", " DOT "))
        return name + at + host + dot + top

    def ip() -> str:
        return draw.choice((".", ".", " . ", "[.]")).join(str(draw.randint(0, 255)) for _ in range(4))

    def card() -> str:
        return draw.choice(("", " ", "-", ".", " - ")).join(digits(4) for _ in range(4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return draw.choice((
            f"+{digits(1)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}",
            f"+{digits(2)} {a} {b} {c}", f"00{digits(2)} {a} {digits(7)}", f"1-{a}-{b}-{c}",
        ))

    def number() -> str:
        return draw.choice((
            digits(1), digits(2), digits(3), f"{draw.randint(1900, 2030)}", digits(6), f"{digits(1)}.{digits(1)}.{digits(1)}",
            f"{digits(2)}.{digits(2)}", f"{draw.randint(1990, 2030)}-{digits(2)}-{digits(2)}", f"{digits(2)}:{digits(2)}",
            f"{digits(2)}%", f"${digits(2)}.{digits(2)}", f"{digits(1)},{digits(3)}", f"v{digits(1)}.{digits(1)}",
            f"isbn {digits(3)}-{digits(1)}", f"order {digits(8)}", f'"{word(3)}{digits(3)}{word(2)}{digits(2)}{word(3)}{digits(4)}"',
            f"{word()}{digits(2)}", f"{digits(2)}-{digits(2)}", f"page {digits(2)}", f"{word()} at {word()}", f"{word()} dot {word()}",
            f"{digits(4)} {word()} {digits(4)}", f"{digits(3)}-{digits(2)}-{digits(4)}", f"#{digits(4)}", f"{digits(2)}/{digits(2)}/{digits(4)}", f"({digits(4)})",
        ))

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    rows = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(draw.randint(1, 3)):
            for _ in range(draw.randint(1, 7)):
                w = word()
                text += (w.capitalize() if draw.random() < 0.2 else w) + draw.choice((" ", " ", " ", " ", ", ", ". ", " | ", "!! "))
            kind = draw.choice((*KINDS, "", "", "", ""))
            if kind:
                hint = {"email": "mail", "ip": "host", "card": "card", "phone": "call"}[kind]
                text += draw.choice(("", "", f"{hint} ", f"{hint}: "))
                made = makers[kind]()
                spans.append((kind, len(text), len(text) + len(made)))
                text += made + draw.choice((" ", " ", ". ", ", ", ""))
                text += "" if text.endswith(" ") else "\n"
            else:
                text += number() + draw.choice((" ", " ", ". ", ", "))
        rows.append((text + word(), spans))
    return rows
