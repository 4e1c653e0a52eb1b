"""Personal data: patterns, and a linear-chain conditional random field over word shapes.

Two sources of spans.  Patterns give e-mail and IP addresses, card and phone numbers of plain form; they always
stay.  A linear-chain conditional random field (CRF) adds what patterns do not see: two cards in a row,
cards of 13 to 15 digits, phones without a plus, written-out or bracketed addresses.

Tokens are runs of digits, letters or blanks and single other characters.  A token's features are its shape, the
shapes around it, a word of a small list at or before it, and the shape and number of digits of the
whole number that it is part of.  Weights come from a small labelled table by
stochastic gradient descent on the log-likelihood (forward and backward sums in numpy).
Texts are decoded by Viterbi, many sequences of tokens at a time as one numpy batch.  Only tokens near a digit, an
at-sign, a bracketed "at" or the word "dot" can be in a span, so only these make up sequences; a
sequence ends at a line end.  Sequences of more than ``PIECE`` tokens are decoded in pieces that overlap.  A span of the CRF has to pass an
exact check of its kind (Luhn sum, four parts up to 255, address form, number of digits) and may not touch a span of a pattern.

How it scales: a narrow operator without a shuffle.  The model is of fixed size and is broadcast.  Texts are decoded
in blocks of a bounded number of characters; longer texts are cut at a line end (or a blank) there.  Patterns go over whole texts in linear time.

Null and empty texts have no spans.  Rows are kept as they are, repeated ones and null ids included; a column of the output's
name is replaced, all others pass through.  Places are code points, ends exclusive.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.llm.pii_examples import examples

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# --- patterns ---------------------------------------------------------------------------------------

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts at the first digit of its run or not at all, which keeps the search linear.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(int(d) for d in digits[::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small_parts(text: str) -> bool:
    return all(len(part.lstrip("0")) < 4 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def _emails(text: str) -> Iterator[Span]:
    """From each at-sign outwards: the run before it and the domain behind it."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield "email", start, free
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))


def base_spans(text: str | None) -> list[Span]:
    """Spans of the patterns, by kind in the order of ``KINDS``, then place."""
    if not text:
        return []
    found = list(_emails(text))
    found += [("ip", *m.span()) for m in _IP.finditer(text) if _small_parts(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() > 15:
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


# --- tokens and features -----------------------------------------------------------------------------

BREAK, BLANK, DIGIT, LETTER, OTHER = range(5)
REACH = 7  # tokens around a digit or at-sign that are decoded
PIECE, MARGIN = 256, 48
BLOCK_CHARS = 1 << 20
BATCH_TOKENS = 1 << 16
HASH_BITS = 13
WORDS = (
    "phone tel telefon telephone téléphone teléfono call fax mobile mobil cell mail email e contact contacto card visa amex "
    "mastercard carte tarjeta karte ip server host ping address at dot com org net isbn order invoice ssn version"
).split()
_WORD = {w: i + 1 for i, w in enumerate(WORDS)}
_BREAKS = (10, 11, 12, 13)


def _classes() -> np.ndarray:
    table = np.full(0x3000, LETTER, np.int8)
    table[:0xC0] = OTHER
    table[[9, 32, 0xA0]] = BLANK
    table[list(_BREAKS)] = BREAK
    for low, high, kind in (("0", "9", DIGIT), ("a", "z", LETTER), ("A", "Z", LETTER)):
        table[ord(low) : ord(high) + 1] = kind
    return table


_CLASS = _classes()


def tokens(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and classes of the tokens of code points; line ends are tokens of their own."""
    kind = _CLASS[np.minimum(points, len(_CLASS) - 1)]
    new = np.ones(len(points), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == OTHER) | (kind[1:] == BREAK)
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], len(points)), kind[starts]


def _is_word(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray, word: str) -> np.ndarray:
    hit = sizes == len(word)
    for i, c in enumerate(word):
        hit[hit] = (points[starts[hit] + i] | 32) == ord(c)
    return hit


def sequences(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of tokens that are decoded: those near a mark, cut at line ends."""
    sizes = ends - starts
    mark = (kind == DIGIT) | (points[starts] == ord("@")) | ((kind == LETTER) & _is_word(points, starts, sizes, "dot"))
    at = np.flatnonzero((kind == LETTER) & _is_word(points, starts, sizes, "at"))
    mark[at[(at > 0) & np.isin(points[starts[np.maximum(at - 1, 0)]], [ord(c) for c in "([{"])]] = True
    near = np.zeros(len(starts) + 1, np.int32)
    where = np.flatnonzero(mark)
    np.add.at(near, np.maximum(where - REACH, 0), 1)
    np.add.at(near, np.minimum(where + REACH + 1, len(starts)), -1)
    inside = (np.cumsum(near[:-1]) > 0) & (kind != BREAK)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _hash(*parts) -> int:
    return zlib.crc32(repr(parts).encode()) & ((1 << HASH_BITS) - 1)


def _shape(text: str, kind: int) -> str:
    if kind == DIGIT:
        return f"d{min(len(text), 20)}"
    if kind == LETTER:
        case = "a" if text.islower() else "A" if text.isupper() else "Aa" if text[1:].islower() else "aA"
        return case + ("1" if len(text) == 1 else "3" if len(text) < 4 else "+")
    if kind == BLANK:
        return " " if len(text) == 1 else "  "
    return text if text < "\x7f" else "?"


_JOINS = frozenset(" -.()/+[]")
_cache: dict[tuple, tuple[int, ...]] = {}


def token_features(words: list[str], kinds: list[int]) -> list[list[int]]:
    """Feature numbers of every token of a sequence."""
    shapes = [_shape(w, k) for w, k in zip(words, kinds)]
    n = len(words)
    group, digits, sooner = [""] * n, [0] * n, [0] * n
    i = 0
    while i < n:
        if kinds[i] != DIGIT:
            i += 1
            continue
        # The number that this run of digits is part of: runs joined by at most two signs.
        a = i
        while a and shapes[a - 1] in ("+", "("):
            a -= 1
        b = last = i
        while b + 1 < n and b - last < 3 and (kinds[b + 1] == DIGIT or shapes[b + 1] in _JOINS):
            b += 1
            if kinds[b] == DIGIT:
                last = b
        whole = "".join(shapes[a : last + 1])[:60]
        count = min(sum(len(words[k]) for k in range(a, last + 1) if kinds[k] == DIGIT), 40)
        passed = 0
        for k in range(a, last + 1):
            group[k], digits[k], sooner[k] = whole, count, min(passed, 40)
            passed += len(words[k]) if kinds[k] == DIGIT else 0
        i = last + 1
    out, before = [], 0
    for i, shape in enumerate(shapes):
        word = _WORD.get(words[i].lower(), 0) if kinds[i] == LETTER else 0
        left, right = shapes[i - 1] if i else "^", shapes[i + 1] if i + 1 < n else "$"
        left2, right2 = shapes[i - 2] if i > 1 else "^", shapes[i + 2] if i + 2 < n else "$"
        small = kinds[i] == DIGIT and len(words[i]) < 4 and int(words[i]) <= 255
        key = (shape, left, right, left2, right2, word, before, small, group[i], digits[i], sooner[i])
        known = _cache.get(key)
        if known is None:
            known = (
                _hash(0, shape), _hash(1, left), _hash(2, right), _hash(3, left2), _hash(4, right2), _hash(5, left, shape, right),
                _hash(6, word), _hash(7, before, kinds[i]), _hash(8, small, left, right), _hash(9, group[i], kinds[i]), _hash(10, digits[i], kinds[i]),
                _hash(11, digits[i], sooner[i], shape),
            )
            if len(_cache) < 1 << 17:
                _cache[key] = known
        out.append(known)
        if word:
            before = word
        elif kinds[i] == LETTER and len(words[i]) > 2:
            before = 0
    return out


# --- the model ----------------------------------------------------------------------------------------

LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
_FORBIDDEN = -1e4
STEPS = 12  # times that training goes over the table
RATE = 0.25


def allowed() -> np.ndarray:
    """Whether a label may follow another; an inner label only its own kind."""
    out = np.ones((len(LABELS), len(LABELS)), bool)
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            out[:, j] = False
            out[[j - 1, j], j] = True
    return out


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers as (sequence, place, feature), and the lengths; beyond the end the numbers are 0."""
    sizes = np.array([len(r) for r in rows])
    out = np.zeros((len(rows), sizes.max(), rows[0].shape[1]), np.int32)
    for own, row in zip(out, rows):
        own[: len(row)] = row
    return out, sizes


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def gradients(model: dict, at: np.ndarray, sizes: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Of the log-likelihood: by (sequence, place, label), by transition, by first label; and the likelihood."""
    emit = model["weights"][at].sum(axis=2)
    batch, longest, labels = emit.shape
    real = np.arange(longest) < sizes[:, None]
    step, first = np.where(model["allowed"], model["step"], _FORBIDDEN), np.where(model["opens"], model["first"], _FORBIDDEN)
    ahead, behind = np.empty_like(emit), np.zeros_like(emit)
    ahead[:, 0] = first + emit[:, 0]
    for t in range(1, longest):
        ahead[:, t] = _log_sum(ahead[:, t - 1][:, :, None] + step, 1) + emit[:, t]
    for t in range(longest - 2, -1, -1):
        more = _log_sum(step + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where((t + 1 < sizes)[:, None], more, 0)
    rows = np.arange(batch)
    whole = _log_sum(ahead[rows, sizes - 1], 1)
    chance = np.exp(ahead + behind - whole[:, None, None]) * real[:, :, None]
    truth = np.zeros_like(emit)
    truth[rows[:, None], np.arange(longest), gold] = 1
    truth *= real[:, :, None]
    by_step = np.zeros((labels, labels))
    score = first[gold[:, 0]] + (emit * truth).sum(axis=(1, 2))
    for t in range(1, longest):
        on = real[:, t]
        pair = ahead[on, t - 1][:, :, None] + step + (emit[on, t] + behind[on, t])[:, None, :] - whole[on, None, None]
        by_step -= np.exp(pair).sum(axis=0)
        np.add.at(by_step, (gold[on, t - 1], gold[on, t]), 1)
        score[on] += step[gold[on, t - 1], gold[on, t]]
    by_first = truth[:, 0].sum(axis=0) - chance[:, 0].sum(axis=0)
    return truth - chance, by_step, by_first, float((score - whole).sum())


def _labelled(text: str, spans: list[Span]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature numbers and gold labels of the sequences of a labelled text."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    starts, ends, kind = tokens(points)
    for a, b in sequences(points, starts, ends, kind):
        words = [text[i:j] for i, j in zip(starts[a:b], ends[a:b])]
        gold = np.zeros(b - a, np.int64)
        for name, low, high in spans:
            inside = np.flatnonzero((starts[a:b] >= low) & (ends[a:b] <= high))
            gold[inside] = LABELS.index(f"I-{name}")
            gold[inside[:1]] = LABELS.index(f"B-{name}")
        yield np.array(token_features(words, kind[a:b].tolist()), np.int32), gold


def train(rows: list[tuple[str, list[Span]]], steps: int = STEPS, batch: int = 48) -> dict:
    """A model from labelled texts: (text, spans)."""
    labels = len(LABELS)
    model = {
        "weights": np.zeros((1 << HASH_BITS, labels)),
        "step": np.zeros((labels, labels)),
        "first": np.zeros(labels),
        "allowed": allowed(),
        "opens": np.array([label[0] != "I" for label in LABELS]),
    }
    made = [pair for text, spans in rows for pair in _labelled(text, spans)]
    squares = {k: np.full_like(model[k], 1e-2) for k in ("weights", "step", "first")}
    draw = np.random.default_rng(5)
    for _ in range(steps if made else 0):
        order = draw.permutation(len(made))
        for k in range(0, len(order), batch):
            chosen = [made[i] for i in order[k : k + batch]]
            at, sizes = _padded([f for f, _ in chosen])
            gold = np.zeros(at.shape[:2], np.int64)
            for own, (_, labels_) in zip(gold, chosen):
                own[: len(labels_)] = labels_
            by_token, by_step, by_first, _ = gradients(model, at, sizes, gold)
            flat = at.reshape(-1, at.shape[2])
            used, place = np.unique(flat, return_inverse=True)
            by_weight = np.zeros((len(used), labels))
            np.add.at(by_weight, place.reshape(flat.shape), by_token.reshape(-1, 1, labels))
            by_weight -= 1e-3 * model["weights"][used]
            squares["weights"][used] += by_weight**2
            model["weights"][used] += RATE * by_weight / np.sqrt(squares["weights"][used])
            for name, slope in (("step", by_step), ("first", by_first)):
                slope = np.where(model["allowed"] if name == "step" else model["opens"], slope, 0)
                squares[name] += slope**2
                model[name] += RATE * slope / np.sqrt(squares[name])
    return model


def viterbi(model: dict, rows: list[np.ndarray]) -> list[np.ndarray]:
    """The likeliest labels of each sequence of feature numbers, in batches of similar length."""
    step = np.where(model["allowed"], model["step"], _FORBIDDEN)
    first = np.where(model["opens"], model["first"], _FORBIDDEN)
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(rows)
    order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
    while order:
        take = max(1, BATCH_TOKENS // len(rows[order[-1]]))
        chosen, order = order[-take:], order[:-take]
        at, sizes = _padded([rows[i] for i in chosen])
        emit = model["weights"][at[:, :, 0]]
        for feature in range(1, at.shape[2]):
            emit += model["weights"][at[:, :, feature]]
        best = first + emit[:, 0]
        came = np.zeros(emit.shape, np.int8)
        for t in range(1, emit.shape[1]):
            ways = best[:, :, None] + step
            came[:, t] = ways.argmax(axis=1)
            best = np.where((t < sizes)[:, None], ways.max(axis=1) + emit[:, t], best)
        label = best.argmax(axis=1)
        labels = np.zeros(emit.shape[:2], np.int64)
        rows_at = np.arange(len(chosen))
        for t in range(emit.shape[1] - 1, -1, -1):
            labels[:, t] = label
            label = np.where(t < sizes, came[rows_at, t, label], label)
        for i, own, size in zip(chosen, labels, sizes):
            out[i] = own[:size]
    return out


# --- spans of the model ----------------------------------------------------------------------------

_AT = re.compile(r"\s*[\[({]\s*at\s*[\])}]\s*|\s+at\s+", re.I)
_DOT = re.compile(r"\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*|\s+dot\s+", re.I)
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_PHONE_FORM = re.compile(r"\+?[0-9(][0-9 ().\-/]*[0-9]")


def passes(kind: str, text: str) -> bool:
    """The exact check of a span of the model."""
    if kind == "email":
        return _ADDRESS.fullmatch(_DOT.sub(".", _AT.sub("@", text))) is not None
    if kind == "ip":
        plain = _DOT.sub(".", text)
        return re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", plain) is not None and _small_parts(plain)
    digits = _digits(text)
    if kind == "card":
        return re.fullmatch(r"[0-9](?:[ .-]?[0-9])+", text) is not None and 13 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 1
    runs = re.findall("[0-9]+", text)
    long_code = len(digits) == 13 and digits[:3] in ("978", "979")
    return (
        _PHONE_FORM.fullmatch(text) is not None
        and 9 <= len(digits) <= 15
        and (len(runs) > 1 or text[0] in "+0")
        and [len(r) for r in runs] != [3, 2, 4]
        and not long_code
    )


def _crf_spans(model: dict, texts: list[str]) -> list[list[Span]]:
    """Checked spans of the model in each of some texts."""
    rows: list[np.ndarray] = []
    places: list[tuple[int, np.ndarray, np.ndarray, int, int]] = []
    for owner, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        starts, ends, kind = tokens(points)
        for a, b in sequences(points, starts, ends, kind):
            for low in range(a, b, PIECE - 2 * MARGIN) if b - a > PIECE else (a,):
                high = min(b, low + PIECE) if b - a > PIECE else b
                words = [text[i:j] for i, j in zip(starts[low:high], ends[low:high])]
                rows.append(np.array(token_features(words, kind[low:high].tolist()), np.int32))
                # What counts of a piece: all but its margins, which other pieces cover.
                places.append((owner, starts[low:high], ends[low:high], 0 if low == a else MARGIN, high - low if high == b else high - low - MARGIN))
                if high == b:
                    break
    out: list[list[Span]] = [[] for _ in texts]
    for (owner, starts, ends, low, high), labels in zip(places, viterbi(model, rows)):
        opened = np.flatnonzero(labels % 2 == 1)
        for i in opened[(opened >= low) & (opened < high)]:
            j = i + 1
            while j < len(labels) and labels[j] == labels[i] + 1:
                j += 1
            kind, text = KINDS[labels[i] // 2], texts[owner]
            a, b = int(starts[i]), int(ends[j - 1])
            alone = not (a and text[a - 1].isalnum()) and not (b < len(text) and text[b].isalnum())
            if alone and passes(kind, text[a:b]):
                out[owner].append((kind, a, b))
    return out


def _cuts(text: str) -> Iterator[tuple[int, int]]:
    """Ranges of a text of a bounded size, cut at line ends, or at blanks in long lines."""
    start = 0
    while len(text) - start > BLOCK_CHARS:
        end = text.rfind("\n", start, start + BLOCK_CHARS) + 1 or text.rfind(" ", start, start + BLOCK_CHARS) + 1
        end = end if end > start else start + BLOCK_CHARS
        yield start, end
        start = end
    yield start, len(text)


def find_spans(texts: list[str | None], model: dict) -> Iterator[list[tuple[str, int, int, bool]]]:
    """For each text its spans (kind, start, end, base), by kind and place."""
    held: list[str | None] = []
    size = 0

    def decoded() -> Iterator[list]:
        pieces = [(k, low, high) for k, text in enumerate(held) for low, high in _cuts(text or "")]
        added: list[list[Span]] = [[] for _ in held]
        part: list[tuple[int, int, int]] = []
        for n, piece in enumerate(pieces):
            part.append(piece)
            if n + 1 == len(pieces) or sum(h - l for _, l, h in part) >= BLOCK_CHARS:
                for (k, low, _), own in zip(part, _crf_spans(model, [(held[k] or "")[l:h] for k, l, h in part])):
                    added[k] += [(kind, a + low, b + low) for kind, a, b in own]
                part = []
        for text, more in zip(held, added):
            base = base_spans(text)
            taken = sorted((a, b) for _, a, b in base)
            lows = [a for a, _ in taken]
            reach = np.maximum.accumulate([b for _, b in taken]) if taken else []
            clear = [s for s in more if not _touches(s, lows, reach)]
            both = [(*s, True) for s in base] + [(*s, False) for s in clear]
            yield sorted(both, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))

    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield from decoded()
            held, size = [], 0
    yield from decoded()


def _touches(span: Span, lows: list[int], reach) -> bool:
    """Does a span overlap one of the sorted ranges?"""
    at = int(np.searchsorted(lows, span[2], "left")) if lows else 0
    return at > 0 and reach[at - 1] > span[1]


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_SPAN_TYPE = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])


def default_model() -> dict:
    return train(examples())


def personal_data(text: Column, shared) -> Column:
    """The spans of a text."""

    @F.arrow_udf(SPANS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = list(find_spans(batch.to_pylist(), shared.value))
            ends = np.cumsum([0, *map(len, rows)])
            flat = [span for row in rows for span in row]
            columns = [pa.array(list(c), t.type) for c, t in zip(zip(*flat) if flat else [[]] * 4, _SPAN_TYPE)]
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_SPAN_TYPE)))

    return scan(text)


def find_personal_data(df: DataFrame, model: dict | None = None, text: str = "text", spans: str = "pii") -> DataFrame:
    """Add the spans of ``text``: kind, start, end, and whether a pattern gives it."""
    shared = df.sparkSession.sparkContext.broadcast(model or default_model())
    return df.withColumn(spans, personal_data(F.col(f"`{text}`"), shared))


def masked_text(text: str | None, spans: list) -> str | None:
    """The text with each span replaced by its kind in angle brackets; spans that overlap are one."""
    if not text or not spans:
        return text
    out, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
        if span["start"] >= at:
            out += [text[at : span["start"]], f"<{span['kind']}>"]
        at = max(at, span["end"])
    return "".join([*out, text[at:]])


def mask_personal_data(df: DataFrame, model: dict | None = None, text: str = "text") -> DataFrame:
    """Replace the personal data in ``text``; a null text stays null."""

    @F.arrow_udf("string")
    def mask(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array(map(masked_text, texts.to_pylist(), spans.to_pylist()), pa.string())

    found = find_personal_data(df, model, text, "_pii")
    return found.withColumn(text, mask(F.col(f"`{text}`"), F.col("_pii"))).drop("_pii")


def pii_report(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """Per document: spans of the patterns by kind and their digest, and all spans."""
    found = find_personal_data(docs.select("doc_id", "text"), model)

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("pii", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("pii")).alias("spans"))
