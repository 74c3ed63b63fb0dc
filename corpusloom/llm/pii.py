"""Personal data: exact patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns find plain emails, addresses, cards and phone numbers. The network finds what they miss:
the same kinds in other writing (defanged, spaced, without a plus, one card after another), and
secrets, for which there is no pattern. It is trained in numpy on labelled spans of two sources:
windows of a bounded sample of documents with the patterns' spans and with the values that are assigned to
names such as token, and windows into which made-up spans in other writing, and made-up text that only
looks like them, are put.

Every kind of span holds a digit or an ``@``; a decoded piece without either is no span. So windows with
neither can add nothing and aren't decoded. All others, which overlap, are decoded, with transitions into
a span's inside barred but from that kind, and the decoded spans of a document are reconciled: parts of
one span that neighbouring windows saw are merged, a span that another window saw whole beats a cut
one, and where kinds disagree the longer span stays. Pattern spans always stay; the network adds spans
that overlap none of them, that have the digits of their kind and, of a card, the check digit, of an address, four parts.

A null text counts as empty and has no spans. Offsets are code points, ends exclusive.
Repeated rows get equal spans. A task holds a slice of 1 MB of text, or one longer text, and decodes 256 windows
at a time, though it keeps the tags (a byte a character) of up to 2048 windows, or of all windows of one text. If no text of the sample has a digit or ``@``, the network adds nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrowtext import over_texts, slices
from corpusloom.session import table

#: Kinds of the patterns, and those that only the network finds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
#: Possessive forms of the contract's patterns: equal matches, in linear time.
_EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_EMAIL_NAME = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Labels of secrets for training: values assigned to a name that tells what they are.
_ASSIGNED = re.compile(r"""(?i)\b(?:token|key|secret|password|passwd|credential)s?["']?[\x20\t]*[=:][\x20\t]*["']?([A-Za-z0-9_+/=-]{16,128})""")
_GATE = "[0-9@]"

#: Characters of a window, and from one to the next.
WINDOW, STRIDE = 96, 32
#: Windows that are decoded at once, and bytes of text that a worker holds at once.
DECODED, SLICE = 256, 1 << 20
#: At most so many windows of about so many documents train the network, and so many that something is put into.
TRAIN_WINDOWS, TRAIN_DOCS, MADE_WINDOWS = 4096, 4000, 4096
EMBED, HIDDEN, STEPS, BATCH, RATE, SEED = 8, 24, 400, 32, 0.03, 5
#: A decoded span must look like its kind: (least digits, most digits, least length); an email also needs an @, an ip four parts, a card the check digit.
SHAPES = {"email": (0, 99, 6), "ip": (4, 12, 7), "card": (16, 19, 16), "phone": (8, 15, 9), "secret": (2, 999, 16)}


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def _emails(text: str):
    """Around each @, the run of name characters that no earlier match took."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
            begin -= 1
        m = _EMAIL_HOST.match(text, at) if begin < at else None
        if m:
            yield begin, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The pattern spans (kind, begin, end), by kind and then by begin."""
    found = [("email", b, e) for b, e in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 16 <= len(m[0]) <= 37 and 16 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def labelled_spans(text: str) -> list[tuple[str, int, int]]:
    """What trains the network in a text: the pattern spans, and assigned secrets with letters and digits."""
    secrets = [m.span(1) for m in _ASSIGNED.finditer(text) if len(_digits(m[1])) >= 2 and any(c.isalpha() for c in m[1])]
    return base_spans(text) + [("secret", b, e) for b, e in secrets]


# Characters as the network sees them.
_SIGNS = "@.-+()%_ ,:;/=#\"'\n\t[]"
#: 0 pads; then digits, lower and upper case ASCII, other letters, other characters, and each sign.
N_CODES = 6 + len(_SIGNS)
_ASCII = np.full(128, 5, np.uint8)
_ASCII[48:58], _ASCII[97:123], _ASCII[65:91] = 1, 2, 3
for _k, _c in enumerate(_SIGNS):
    _ASCII[ord(_c)] = 6 + _k


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _ASCII[np.minimum(points, 127)], 4).astype(np.uint8)


def windows_of(seen: np.ndarray) -> np.ndarray:
    """Where the windows with a digit or an @ begin, on a grid of STRIDE."""
    cells = np.flatnonzero((seen == 1) | (seen == 6)) // STRIDE
    return np.unique(np.maximum(0, np.concatenate([cells - k for k in range(WINDOW // STRIDE)]))) * STRIDE


N_TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


#: Steps into the inside of a kind are barred but from that kind; a window may begin inside.
BARRED = np.zeros((N_TAGS, N_TAGS), np.float32)
for _k in range(len(KINDS)):
    BARRED[:, 2 * _k + 2] = -1e4
    BARRED[2 * _k + 1 : 2 * _k + 3, 2 * _k + 2] = 0


def tags_of(spans: list[tuple[str, int, int]], length: int) -> np.ndarray:
    """A tag per character; where kinds overlap, the longer span counts."""
    tags = np.zeros(length, np.uint8)
    for kind, b, e in sorted(spans, key=lambda s: s[2] - s[1]):
        k = 1 + 2 * KINDS.index(kind)
        tags[b:e] = k + 1
        tags[b] = k
    return tags


def _letters(rng, some: str, low: int, high: int) -> str:
    return "".join(rng.choice(list(some), int(rng.integers(low, high + 1))))


def _card(rng) -> str:
    body = _letters(rng, "0123456789", 15, 15)
    return next(body + c for c in "0123456789" if _luhn(body + c))


def made_up(rng) -> list[tuple[str, str | None]]:
    """Pieces of text with their kinds: personal data in some writing, or text that only looks like it."""
    digit, lower, both = "0123456789", "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    what = int(rng.integers(0, 12))
    pick = lambda *x: x[int(rng.integers(0, len(x)))]
    quote, context = pick('"', "'", ""), pick("token = ", "key: ", "secret=", "password: ", "auth ", "", "", "", "")
    if what == 0:
        at, dot = pick("@", " @ ", "@ "), pick(".", "[.]", " . ", "(.)")
        return [(_letters(rng, lower + digit + "._", 3, 12).strip("._") + "x" + at + _letters(rng, lower, 3, 9) + dot + pick("com", "net", "org", "example" + dot + "com"), "email")]
    if what == 1:
        return [(pick(".", "[.]", " . ", "(.)", " ."). join(str(int(x)) for x in rng.integers(0, 256, 4)), "ip")]
    if what in (2, 3):
        first, second = _card(rng), _card(rng)
        if what == 2:
            return [(first, "card"), (" ", None), (second, "card")]
        return [(pick(".", "/", "_", "--", " - ", "\n", ":").join(first[k : k + 4] for k in range(0, 16, 4)), "card")]
    if what == 4:
        a, b, c = (_letters(rng, digit, n, n) for n in (3, 3, 4))
        return [(pick(f"({a}) {b}-{c}", f"001 {a} {b} {c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"001-{a}-{b}-{c}"), "phone")]
    if what in (5, 6):
        body = pick(_letters(rng, digit + "abcdef", 24, 64), _letters(rng, digit + "ABCDEF", 24, 64), pick("sk_", "gh_", "", "") + _letters(rng, both, 20, 48))
        return [(context + quote, None), (body[:-2] + _letters(rng, digit, 2, 2), "secret"), (quote, None)]
    y, m, d = int(rng.integers(1900, 2100)), int(rng.integers(1, 13)), int(rng.integers(1, 29))
    return [(pick(
        f"{y}-{m:02}-{d:02}", f"{d:02}.{m:02}.{y}", f"Version {m}.{d}.", f"{d}.{m}.{y % 100}", f"{y},{d:02}{m}.{d:02}", f"{m}:{d:02}:{d:02}", _letters(rng, digit, 1, 7), _letters(rng, digit, 20, 40), _letters(rng, lower, 16, 40) + pick("", "1"),
        f"{_letters(rng, lower, 3, 8).title()}{d}", f"/{_letters(rng, lower, 3, 8)}/{y}/{m}/{_letters(rng, lower, 3, 8)}.html", f"#{_letters(rng, digit + 'abcdef', 6, 6)}", f"@{_letters(rng, lower, 3, 9)}", f"{context}{quote}{_letters(rng, lower, 4, 9)}{quote}", f"{d} - {m} = {y}", f"({y})", f"p. {d}-{d + m}",
    ), None)]


def put_into(seen: np.ndarray, tags: np.ndarray, n: int = MADE_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """n windows without spans, drawn from the given ones, with something made up in each."""
    rng = np.random.default_rng(SEED)
    plain = seen[~tags.any(1)]
    plain = plain if len(plain) else np.full((1, WINDOW), 2, np.uint8)
    out, marks = plain[rng.integers(0, len(plain), n)].copy(), np.zeros((n, WINDOW), np.uint8)
    for k in range(n):
        pieces = made_up(rng)
        text = "".join(t for t, _ in pieces)
        at = int(rng.integers(-min(8, len(text) // 2), WINDOW - 4))  # may be cut at either end
        text_codes, text_tags, done = codes(" " + text + " "), np.zeros(len(text) + 2, np.uint8), 1
        for t, kind in pieces:
            if kind:
                text_tags[done : done + len(t)] = tags_of([(kind, 0, len(t))], len(t))
            done += len(t)
        b, e = max(0, -at), min(len(text_codes), WINDOW - at)
        out[k, at + b : at + e], marks[k, at + b : at + e] = text_codes[b:e], text_tags[b:e]
    return out, marks


def cut(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    padded = np.concatenate((values, np.zeros(WINDOW, values.dtype)))
    return padded[begins[:, None] + np.arange(WINDOW)]


def best_tags(emissions: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Viterbi: of each window, the tags with the highest sum of emissions (time x windows x tags) and steps."""
    score, back = emissions[0], []
    for t in range(1, len(emissions)):
        way = score[:, :, None] + step
        back.append(way.argmax(1).astype(np.uint8))
        score = way.max(1) + emissions[t]
    best = [score.argmax(1).astype(np.uint8)]
    for b in reversed(back):
        best.append(np.take_along_axis(b, best[-1][:, None], 1)[:, 0])
    return np.stack(best[::-1], 1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tagger:
    """Embedding, one LSTM for each direction, a linear layer, and CRF transitions."""

    p: dict[str, np.ndarray]

    @staticmethod
    def fresh() -> Tagger:
        rng = np.random.default_rng(SEED)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        p = {"embed": draw(N_CODES, EMBED) * 3, "out": draw(2 * HIDDEN, N_TAGS), "bias": np.zeros(N_TAGS, np.float32), "step": np.zeros((N_TAGS, N_TAGS), np.float32)}
        for d in "fb":
            p |= {f"x{d}": draw(EMBED, 4 * HIDDEN), f"h{d}": draw(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
            p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
        return Tagger(p)

    def _lstm(self, x: np.ndarray, d: str, learn: bool = True):
        """x is time x windows x EMBED; returns the outputs and, to learn, what the way back needs."""
        steps, n, _ = x.shape
        pre = x @ self.p[f"x{d}"] + self.p[f"c{d}"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, memory = np.empty((steps, n, HIDDEN), np.float32), []
        for t in range(steps):
            z = pre[t] + h @ self.p[f"h{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            g = np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            was, c = c, f * c + i * g
            tc = np.tanh(c)
            if learn:
                memory.append((i, f, o, g, was, tc, h))
            h = o * tc
            out[t] = h
        return out, memory

    def _lstm_back(self, x, d, memory, grad, into):
        dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
        dx = np.empty_like(x)
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, was, tc, h = memory[t]
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - tc**2)
            dz = np.concatenate((dc * g * i * (1 - i), dc * was * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)), 1)
            into[f"x{d}"] += x[t].T @ dz
            into[f"h{d}"] += h.T @ dz
            into[f"c{d}"] += dz.sum(0)
            dx[t] = dz @ self.p[f"x{d}"].T
            dh, dc = dz @ self.p[f"h{d}"].T, dc * f
        return dx

    def emissions(self, seen: np.ndarray, learn: bool = True):
        """Scores of the tags, time x windows x N_TAGS, of windows of codes."""
        x = self.p["embed"][seen.T]
        f, mf = self._lstm(x, "f", learn)
        b, mb = self._lstm(x[::-1], "b", learn)
        both = np.concatenate((f, b[::-1]), 2)
        return both @ self.p["out"] + self.p["bias"], (x, both, mf, mb)

    def decode(self, seen: np.ndarray) -> np.ndarray:
        """The best tag sequence of each window, of those that enter a span's inside from that kind only."""
        step = self.p["step"] + BARRED
        return np.concatenate([best_tags(self.emissions(seen[k : k + DECODED], False)[0], step) for k in range(0, max(1, len(seen)), DECODED)])

    def gradient(self, seen: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags under the CRF, and its gradient."""
        e, (x, both, mf, mb) = self.emissions(seen)
        steps, n, _ = e.shape
        move = self.p["step"]
        total = lambda v, axis: (m := v.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(v - m).sum(axis))
        ahead, behind = [e[0]], [np.zeros_like(e[0])]
        for t in range(1, steps):
            ahead.append(total(ahead[-1][:, :, None] + move, 1) + e[t])
            behind.append(total((behind[-1] + e[steps - t])[:, None, :] + move, 2))
        behind = behind[::-1]
        z = total(ahead[-1], 1)
        rows, want = np.arange(n), tags.T.astype(int)
        gold = sum(e[t][rows, want[t]] for t in range(steps)) + sum(move[want[t - 1], want[t]] for t in range(1, steps))
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        de = np.exp(np.stack(ahead) + np.stack(behind) - z[:, None])
        for t in range(1, steps):
            pair = np.exp(ahead[t - 1][:, :, None] + move + (e[t] + behind[t])[:, None, :] - z[:, None, None])
            grads["step"] += pair.sum(0)
            np.add.at(grads["step"], (want[t - 1], want[t]), -1)
        for t in range(steps):
            de[t][rows, want[t]] -= 1
        grads["out"] = np.tensordot(both, de, ((0, 1), (0, 1)))
        grads["bias"] = de.sum((0, 1))
        dboth = de @ self.p["out"].T
        dx = self._lstm_back(x, "f", mf, dboth[:, :, :HIDDEN], grads)
        dx = dx + self._lstm_back(x[::-1], "b", mb, dboth[::-1, :, HIDDEN:], grads)[::-1]
        np.add.at(grads["embed"], seen.T, dx)
        return float((z - gold).mean()), {k: (v / n).astype(np.float32) for k, v in grads.items()}

    def fit(self, seen: np.ndarray, tags: np.ndarray, steps: int | None = None) -> float:
        """Adam with clipped gradients and a falling rate; returns the mean loss of the last batches."""
        rng, steps = np.random.default_rng(SEED), steps or STEPS
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        losses = []
        for k in range(1, steps + 1):
            pick = rng.integers(0, len(seen), min(BATCH, len(seen)))
            loss, grads = self.gradient(seen[pick], tags[pick])
            losses.append(loss)
            norm = float(np.sqrt(sum((g**2).sum() for g in grads.values())))
            rate = RATE * min(1, k / 20) * (1 - (k - 1) / steps)
            for name, g in grads.items():
                g = g * min(1, 4 / max(norm, 1e-9))
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.99 * v[name] + 0.01 * g**2
                self.p[name] = self.p[name] - rate * (m[name] / (1 - 0.9**k)) / (np.sqrt(v[name] / (1 - 0.99**k)) + 1e-8)
        return float(np.mean(losses[-20:]))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Tagger | None:
    """Fit on windows of a bounded sample; None if there are none.

    The rate of documents is set so that about TRAIN_DOCS with a digit or @ are drawn, by a hash of
    their text, and windows are drawn by a hash of what is seen in them.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text")).where(F.col("text").rlike(_GATE))
    n = rows.count()
    drawn = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < min(1.0, TRAIN_DOCS / max(1, n)) * 1_000_003)

    def cut_windows(batches):
        for part in slices(batches):
            for t in part.column("text").to_pylist():
                seen = codes(t)
                begins = windows_of(seen)
                tags = tags_of(labelled_spans(t), len(seen))
                yield pa.RecordBatch.from_arrays([pa.array(list(map(bytes, cut(x, begins))), pa.binary()) for x in (seen, tags)], ["seen", "tags"])

    made = drawn.mapInArrow(cut_windows, "seen binary, tags binary").distinct()
    rows = made.orderBy(F.xxhash64("seen"), "seen", "tags").limit(TRAIN_WINDOWS).collect()
    seen, tags = (np.frombuffer(b"".join(bytes(r[c]) for r in rows), np.uint8).reshape(-1, WINDOW) for c in ("seen", "tags"))
    if not len(seen):
        return None
    model, (more, marks) = Tagger.fresh(), put_into(seen, tags)
    model.fit(np.concatenate((seen, more)), np.concatenate((tags, marks)))
    return model


def reconcile(begins: np.ndarray, tags: np.ndarray, seen: np.ndarray) -> list[tuple[str, int, int]]:
    """Spans of a whole text from the tags of its overlapping windows; pieces without a digit or @ are none."""
    pieces, length = [], len(seen)
    gates = np.concatenate(([0], np.cumsum((seen == 1) | (seen == 6))))
    for w, row in zip(begins.tolist(), tags):
        at = 0
        some = np.flatnonzero(row)
        while len(some):
            b = int(some[0])
            kind = (int(row[b]) - 1) // 2
            e = b + 1
            while e < WINDOW and row[e] == 2 * kind + 2:
                e += 1
            torn = (b == 0 and w > 0) or (e == WINDOW and w + WINDOW < length)
            at, end = e, min(w + e, length)
            if end > w + b and gates[end] > gates[w + b]:
                pieces.append((kind, w + b, end, torn))
            some = some[some >= at]
    merged: list[list[int]] = []
    for kind, b, e, torn in sorted(set(pieces)):  # by kind and begin: overlapping parts of one span become one
        if merged and merged[-1][0] == kind and b < merged[-1][2]:
            merged[-1][2], merged[-1][3] = max(merged[-1][2], e), merged[-1][3] and torn
        else:
            merged.append([kind, b, e, torn])
    out: list[tuple[str, int, int]] = []
    for kind, b, e, _ in sorted(merged, key=lambda s: (s[3], s[1] - s[2], s[1])):
        if all(e <= b2 or e2 <= b for _, b2, e2 in out):
            out.append((KINDS[kind], b, e))
    return out


def _four(s: str) -> bool:
    """Whether the numbers in s are four, of at most 255."""
    parts = re.findall("[0-9]+", s)
    return len(parts) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in parts)


def _fits(kind: str, s: str) -> bool:
    low, high, least = SHAPES[kind]
    digits = _digits(s)
    return low <= len(digits) <= high and len(s) >= least and (kind != "email" or "@" in s[1:-1]) and (kind != "card" or _luhn(digits)) and (kind != "ip" or _four(s)) and (kind != "secret" or any(c.isalpha() for c in s) and s.isascii() and not any(c.isspace() for c in s)) and s == s.strip()


def all_spans(texts: list[str], model: Tagger | None) -> list[tuple[list, list]]:
    """(pattern spans, spans that the network adds) of each text."""
    base = [base_spans(t) for t in texts]
    added: list[list] = [[] for _ in texts]
    if model is None:
        return list(zip(base, added))
    seen = [codes(t) for t in texts]
    begins = [windows_of(s) for s in seen]
    for some in _batches([len(b) for b in begins], 2048):
        # a text of very many windows is decoded in parts, and reconciled as a whole
        decoded = np.concatenate([model.decode(cut(seen[k], begins[k][i : i + 2048])) for k in some for i in range(0, max(1, len(begins[k])), 2048)]) if len(some) == 1 else model.decode(np.concatenate([cut(seen[k], begins[k]) for k in some]))
        at = 0
        for k in some:
            mine = decoded[at : at + len(begins[k])]
            at += len(begins[k])
            taken = [(b, e) for _, b, e in base[k]]
            for kind, b, e in reconcile(begins[k], mine, seen[k]):
                if _fits(kind, texts[k][b:e]) and all(e <= b2 or e2 <= b for b2, e2 in taken):
                    added[k].append((kind, b, e))
    return list(zip(base, added))


def _batches(sizes: list[int], limit: int):
    group, total = [], 0
    for k, n in enumerate(sizes):
        if group and total + n > limit:
            yield group
            group, total = [], 0
        group.append(k)
        total += n
    if total:
        yield group


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{b}:{e}" for k, b, e in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find_spans(docs: DataFrame, model: Tagger | None, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, base and spans (kind:begin:end, comma-joined: the patterns' and all), and redacted.

    redacted is the text with [KIND] in place of each span.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = held.value

        def each(part):
            column = pc.fill_null(part.column(text), "")
            gated = np.flatnonzero(pc.match_substring_regex(column, _GATE).to_numpy(zero_copy_only=False))
            texts = column.take(pa.array(gated, pa.int64())).to_pylist()
            base, spans, redacted = [""] * part.num_rows, [""] * part.num_rows, {}
            for k, t, (b, more) in zip(gated.tolist(), texts, all_spans(texts, model)):
                base[k], spans[k] = _written(b), _written(b + more)
                if b or more:
                    redacted[k] = redact(t, b + more)
            clean = column
            if redacted:
                hit = np.zeros(part.num_rows, bool)
                hit[list(redacted)] = True
                clean = pc.replace_with_mask(column, pa.array(hit), pa.array([redacted[k] for k in sorted(redacted)], column.type))
            return {"base": pa.array(base, pa.string()), "spans": pa.array(spans, pa.string()), "redacted": clean}

        return each

    return over_texts(docs, keep, "base string, spans string, redacted string", make, text, SLICE)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Overlapping spans are replaced together, by the name of the first."""
    out, at = [], 0
    for kind, b, e in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b >= at:
            out += [text[at:b], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_spans(docs, train(docs), ["doc_id"])
    count = lambda c, k: F.regexp_count(c, F.lit(f"{k}:")).cast("bigint")
    counts = [count("base", k).alias(f"n_{k}") for k in BASE_KINDS]
    network = (F.regexp_count("spans", F.lit(r"[a-z]:")) - F.regexp_count("base", F.lit(r"[a-z]:"))).cast("bigint")
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans", count("spans", "secret").alias("n_secret"), network.alias("n_network"))


def redacted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the texts with all spans replaced, and their new length in n_chars, if there is such a column."""
    plain = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)))
    mine = f"c{docs.columns.index('text')}"
    found = find_spans(plain, train(docs), plain.columns, mine)
    new = {"text": F.when(F.col(mine).isNotNull(), F.col("redacted"))}
    if "n_chars" in docs.columns:
        old = F.col(f"c{docs.columns.index('n_chars')}")
        new["n_chars"] = F.when(F.col("spans") == "", old).otherwise(F.char_length("redacted").cast(docs.schema["n_chars"].dataType))
    return found.select(*(new.get(c, F.col(f"c{k}")).alias(c) for k, c in enumerate(docs.columns)))
