"""Secret scans: fixed patterns, and a character convolutional network for what the patterns miss.

The patterns give the base findings, which always stay. Every other candidate - a run of 8 or more characters that a
secret may be made of, with a digit or a sudden capital in it, or the value after any name and : or = - is scored, with its
surrounding context, by a small convolutional network in numpy: embedded characters, convolutions of two widths, the
largest and the mean response of every filter, one hidden layer. A candidate longer than ``INSIDE`` characters is
scored in overlapping windows over its whole length, each with its own context. Candidates of which a window reaches
the threshold of its kind are added as ``model`` spans.

The network learns from labelled findings, a bounded number by hash: base findings of all documents are the secrets,
other candidates in a sample of the documents are not, unless they are or look like one of the secrets: those are not
taught at all. Both are taught as ``scan`` meets them, in its windows. Since the base findings are what the patterns know
already, every finding is also shown with its value replaced: a secret by random characters of other alphabets, lengths
and prefixes, and by passphrases after a name that calls for one, a harmless candidate by paths, addresses, versions,
identifiers, numbers and UUIDs, in contexts of other findings and after other names. So what the network learns is how a
value looks, and how its name and value go together.

Its scores are calibrated (Platt) on a fifth of the findings that it was not fitted on, replaced in the same way, and each
kind's threshold is the highest that keeps ``RECALL`` of these held-out secrets of its kind. The replaced values see to it
that each kind has at least ``LEAST_HELD`` of them whatever the corpus holds; a corpus in which one kind is rare thus has
that kind's threshold set by replaced values.

Defined results: a null or empty text has no spans; repeated rows are reported each; without base findings
nothing is added; an empty table gives no rows; other columns are ignored, whatever their names. Positions
count code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, strings, text_of

# Fixed patterns of the base findings: kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.IGNORECASE | re.ASCII), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
KINDS = {"assign": 0, "access": 1, "hex": 2, "model": 3}
# Before the last step the hex pattern matches every a to f and digit; 32 of them in a row are looked for first.
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
_VALUE = re.compile(r"""[:=]\x20*["']?([A-Za-z0-9+/_.=-]{8,})""")
_SIGN = re.compile(r"""[:=]\x20*["']?$""")
_PART = re.compile(r"[/=]+")
_SECRETIVE = re.compile(r"[0-9]|[a-z][A-Z]|[A-Z]{3}[a-z]")

SAMPLE_DOCS = 20_000        # documents that are searched for candidates that are no secrets, at most
SAMPLE_FINDINGS = 6_000     # findings that the network is fitted on, at most
OTHER, SECRET, CONTEXT = 0, 1, 2
APART = 400                 # characters between places that are taken as contexts
RECALL = 0.97
MADE = 30_000               # made-up findings of either label that are shown for fitting, and a quarter of that for calibrating
LEAST_HELD = 50             # held-out secrets of a kind that may set its threshold
BEFORE, INSIDE, AFTER = 24, 40, 8
LENGTH = BEFORE + INSIDE + AFTER
BATCH = 4096                # windows that are encoded at a time
SYMBOLS = 98                # printable ASCII, line feed, beyond ASCII, padding, and one that starts the candidate

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The base findings, by start and then kind."""
    out = []
    for kind, pattern, group, least in BASE:
        found = _LONG_HEX.finditer(text) if kind == "hex" else pattern.finditer(text)
        out += [(kind, m.start(), m.end()) for m in found if m.end(group) - m.start(group) >= least]
    return sorted(out, key=lambda s: (s[1], KINDS[s[0]], s[2]))


def assigned(text: str) -> dict[int, int]:
    """The beginnings of the values of 8 or more characters after a name and : or =, by their ends."""
    out = {}
    for m in _VALUE.finditer(text):
        at = m.start() - 1
        while at >= 0 and text[at] == " ":
            at -= 1
        if at >= 1 and text[at] in "\"'":
            at -= 1
        if at >= 0 and (text[at].isalnum() or text[at] == "_"):
            out[m.end()] = m.start(1)
    return out


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Runs that may be secrets and values of assignments, those that touch no base finding."""
    out, k = [], 0
    ordered = sorted((b, e) for _, b, e in base)
    values = assigned(text)
    for m in _RUN.finditer(text):
        start, end = m.span()
        if not _SECRETIVE.search(m[0]):
            if end not in values:
                continue
            start = values[end]
        while k < len(ordered) and ordered[k][1] <= start:
            k += 1
        if all(b >= end or e <= start for b, e in ordered[k:k + 4]):
            out.append((start, end))
    return out


def kind_of(value: str, before: str = "") -> int:
    """0: hex digits alone, 1: capitals and digits, 2: anything else, 3: anything else after : or =."""
    own = value.rpartition("=")[2] or value
    if re.fullmatch("[0-9a-f]+", own):
        return 0
    return 1 if re.fullmatch("[A-Z0-9]+", own) else 3 if len(own) < len(value) or _SIGN.search(before) else 2


_CODE = np.full(128, 96, np.int16)
_CODE[32:127] = np.arange(95)
_CODE[10] = 95


def encode(before: str, inside: str, after: str) -> np.ndarray:
    """Character numbers of a candidate and its context; 97 fills up."""
    out = np.full(LENGTH, 97, np.int16)
    for part, start, room, right in ((before, 0, BEFORE, True), (inside, BEFORE, INSIDE, False), (after, BEFORE + INSIDE, AFTER, False)):
        part = part[-room:] if right else part[:room]
        codes = np.array([ord(c) for c in part], np.int64)
        codes = np.where(codes < 128, _CODE[np.minimum(codes, 127)], 96)
        out[start + (room - len(part) if right else 0):][:len(part)] = codes
    return out


def encode_at(text: str, start: int, end: int) -> np.ndarray:
    return encode(text[max(0, start - BEFORE):start], text[start:end], text[end:end + AFTER])


def windows(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The whole of a candidate, or overlapping windows of ``INSIDE`` characters; a part after / or = also begins one."""
    if end - start <= INSIDE:
        yield start, end
        return
    last = end - INSIDE
    for at in range(start, last, INSIDE // 2):
        yield at, at + INSIDE
    yield last, end
    for m in _PART.finditer(text, start, end):
        if end - m.end() >= 8:
            yield m.end(), min(end, m.end() + INSIDE)


@dataclass
class Network:
    """The convolutional network, its calibration and its thresholds."""

    parameters: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    thresholds: list[float] = field(default_factory=lambda: [2.0] * 4)

    def raw(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([_forward(self.parameters, codes[k:k + 512])[0] for k in range(0, len(codes), 512)]) \
            if len(codes) else np.zeros(0)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(codes) + self.shift, -60, 60)))


LEFT_OUT, DECAY = 0.4, 4e-4
WIDTHS, FILTERS, EMBEDDED, HIDDEN = (3, 6), 32, 10, 48


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    p = {"embed": rng.normal(0, 0.5, (SYMBOLS, EMBEDDED)), "h": rng.normal(0, 0.15, (4 * FILTERS * len(WIDTHS), HIDDEN)),
         "hb": np.zeros(HIDDEN), "o": rng.normal(0, 0.2, HIDDEN), "ob": np.zeros(1)}
    for w in WIDTHS:
        p[f"c{w}"] = rng.normal(0, (w * EMBEDDED) ** -0.5, (w * EMBEDDED, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _parts(width: int) -> tuple[slice, slice]:
    """The places of a filter that begin before the candidate, and those from its beginning on."""
    return slice(0, BEFORE), slice(BEFORE, LENGTH - width + 1)


def _forward(p: dict[str, np.ndarray], codes: np.ndarray, mask: np.ndarray | float = 1.0) -> tuple[np.ndarray, dict]:
    x = p["embed"][codes]
    kept: dict = {"x": x}
    pooled = []
    for w in WIDTHS:
        view = np.lib.stride_tricks.sliding_window_view(x, w, axis=1)            # rows, places, embedded, w
        cols = view.transpose(0, 1, 3, 2).reshape(len(x), LENGTH - w + 1, w * EMBEDDED)
        y = np.maximum(cols @ p[f"c{w}"] + p[f"b{w}"], 0)
        kept[w] = (cols, y)
        for part in _parts(w):
            pooled += [y[:, part].max(axis=1), y[:, part].mean(axis=1)]
    flat = np.concatenate(pooled, axis=1) * mask
    hidden = np.maximum(flat @ p["h"] + p["hb"], 0)
    kept |= {"flat": flat, "hidden": hidden}
    return hidden @ p["o"] + p["ob"][0], kept


def _gradient(p: dict[str, np.ndarray], codes: np.ndarray, labels: np.ndarray,
              mask: np.ndarray | float = 1.0) -> dict[str, np.ndarray]:
    """Of the mean log loss; ``mask`` multiplies the pooled responses."""
    out, kept = _forward(p, codes, mask)
    g = ((1 / (1 + np.exp(-np.clip(out, -60, 60))) - labels) / len(labels)).astype(np.float32)
    grad = {"o": kept["hidden"].T @ g, "ob": g.sum(keepdims=True)}
    gh = np.outer(g, p["o"]) * (kept["hidden"] > 0)
    grad |= {"h": kept["flat"].T @ gh, "hb": gh.sum(axis=0)}
    gf, at = (gh @ p["h"].T) * mask, 0
    gx = np.zeros_like(kept["x"])
    rows = np.arange(len(codes))[:, None]
    for w in WIDTHS:
        cols, y = kept[w]
        gy = np.zeros_like(y)
        for part in _parts(w):
            top = y[:, part].argmax(axis=1) + part.start
            gy[rows, top, np.arange(FILTERS)[None, :]] += gf[:, at:at + FILTERS]
            gy[:, part] += gf[:, None, at + FILTERS:at + 2 * FILTERS] / (part.stop - part.start)
            at += 2 * FILTERS
        gy *= y > 0
        grad[f"c{w}"] = np.tensordot(cols, gy, ((0, 1), (0, 1)))
        grad[f"b{w}"] = gy.sum(axis=(0, 1))
        gc = (gy @ p[f"c{w}"].T).reshape(len(codes), LENGTH - w + 1, w, EMBEDDED)
        for k in range(w):
            gx[:, k:k + LENGTH - w + 1] += gc[:, :, k]
    grad["embed"] = np.zeros_like(p["embed"])
    np.add.at(grad["embed"], codes, gx)
    return grad


def _fit_network(codes: np.ndarray, labels: np.ndarray, rng: np.random.Generator, steps: int = 4000, size: int = 96) -> dict:
    """Adam over batches with as many secrets as others, in steps that become smaller, with responses left out at random."""
    p = _start(rng)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    yes, no = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    for t in range(1, steps + 1):
        some = np.concatenate([rng.choice(yes, size // 2), rng.choice(no, size // 2)])
        mask = ((rng.random((size, p["h"].shape[0])) > LEFT_OUT) / (1 - LEFT_OUT)).astype(np.float32)
        for k, g in _gradient(p, codes[some], labels[some], mask).items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] = p[k] * (1 - DECAY) - 0.004 * (1 - 0.9 * t / steps) * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return {k: x.astype(np.float32) for k, x in p.items()}


def _calibrate(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Platt's slope and shift, by gradient steps on the log loss with softened labels."""
    yes, no = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    target = np.where(labels == 1, (yes + 1) / (yes + 2), 1 / (no + 2))
    a, b = 1.0, 0.0
    scale = max(1.0, float(np.abs(raw).max()))
    for _ in range(2000):
        d = 1 / (1 + np.exp(-(a * raw + b))) - target
        a -= 0.5 * float((d * raw).mean()) / scale
        b -= 0.5 * float(d.mean())
    return a, b


# Alphabets of made-up secrets, names that call for one, names that do not, and words of harmless candidates.
ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
SECRET_NAMES = ("pwd", "pass", "passphrase", "passcode", "pw", "credential", "credentials", "auth", "auth_key", "access_key",
                "private_key", "client_key", "signing_key", "encryption_key", "bearer", "login_pass", "db_pwd", "userpass")
PLAIN_NAMES = ("note", "title", "name", "path", "url", "host", "lang", "version", "color", "id", "file", "date", "size", "type",
               "user", "label", "section", "chapter", "ref", "class", "href", "src", "page", "status", "city", "format", "mode",
               "build", "commit_message", "topic", "subject", "author", "image", "package", "module", "style")
WORDS = ("usr", "local", "lib", "bin", "home", "data", "src", "main", "test", "site", "package", "packages", "config", "share",
         "python", "java", "node", "module", "report", "image", "photo", "index", "user", "admin", "service", "server", "client",
         "table", "column", "value", "release", "version", "build", "docs", "example", "sample", "project", "system", "backup",
         "archive", "public", "private", "static", "content", "media", "upload", "download", "model", "train", "batch", "result",
         "output", "input", "engine", "query", "spark", "hadoop", "apache", "google", "github", "summer", "winter", "river",
         "mountain", "green", "orange", "silver", "monday", "january", "street", "market", "window", "garden", "letter", "number",
         "people", "family", "history", "science", "music", "travel", "kitchen", "football", "weather", "newspaper", "horse",
         "battery", "staple", "correct", "dragon", "coffee", "purple", "monkey", "thunder", "castle", "internal", "cluster",
         "worker", "driver", "update", "account", "payment", "invoice", "order", "product", "customer", "region", "north", "south",
         "resources", "templates", "components", "utils", "common", "helper", "scripts", "assets", "session", "handler", "manager")
# Parts of syllables, of which words are made that no list has.
ONSETS = ("", "", "b", "br", "c", "ch", "cl", "cr", "d", "dr", "f", "fl", "fr", "g", "gr", "h", "j", "k", "l", "m", "n", "p", "pl", "pr",
          "qu", "r", "s", "sc", "sh", "sl", "sp", "st", "str", "t", "th", "tr", "v", "w", "wh", "y", "z")
NUCLEI = ("a", "a", "e", "e", "i", "i", "o", "o", "u", "ai", "ea", "ee", "ie", "io", "oo", "ou", "y")
CODAS = ("", "", "", "", "b", "ck", "ct", "d", "f", "g", "l", "ll", "m", "mp", "n", "nd", "ng", "nt", "p", "r", "rd", "rk", "rm", "s",
         "ss", "st", "t", "te", "th", "ve", "x", "tion", "ment", "er", "ing", "ed", "ly", "able")
ENDINGS = ("txt", "pdf", "html", "png", "jpg", "py", "java", "json", "csv", "xml", "md", "js", "css", "tar.gz", "parquet", "log")
HOSTS = ("com", "org", "net", "io", "de", "internal", "local", "edu")


class Maker:
    """Made-up secrets and harmless candidates, with the contexts of a set of findings. ``words`` are some of the corpus."""

    def __init__(self, rng: np.random.Generator, contexts: list[tuple[str, str]], words: list[str]):
        self.rng, self.contexts, self.words = rng, contexts or [("", "")], [*words, *WORDS]

    def of(self, values):
        return values[int(self.rng.integers(len(values)))]

    def number(self, low: int, high: int) -> int:
        return int(self.rng.integers(low, high + 1))

    def chars(self, alphabet: str, low: int, high: int) -> str:
        return "".join(alphabet[k] for k in self.rng.integers(len(alphabet), size=self.number(low, high)))

    def word(self) -> str:
        if self.number(0, 1):
            return self.of(self.words)
        return "".join(self.of(ONSETS) + self.of(NUCLEI) + self.of(CODAS) for _ in range(self.of((1, 2, 2, 3))))

    def random_value(self, low: int) -> str:
        """Characters at random, at times after a short prefix, as issuers of tokens write it."""
        value = self.chars(self.of(ALPHABETS), low, self.of((24, 32, 40, 64)))
        if self.number(0, 3) == 0:
            value = self.chars("abcdefghijklmnopqrstuvwxyz", 2, 4) + self.of("_-") + value
        return value + ("=" if self.number(0, 15) == 0 else "")

    def passphrase(self) -> str:
        """What people choose: words and digits run together, or letters and digits of their own."""
        if self.number(0, 2):
            value = self.people()
        else:
            value = self.chars(self.of(ALPHABETS[2:6] + ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")), 8, 24)
        return (value + "0" * 8)[:max(8, len(value))]

    def people(self) -> str:
        value = "".join(self.of((str.lower, str.lower, str.title))(self.word()) for _ in range(self.number(1, 4)))
        return value + (self.chars("0123456789", 1, 4) if self.number(0, 1) else "")

    def named(self, names: tuple[str, ...]) -> str:
        """A name, its sign, and what stands before the value."""
        name = self.of((str.lower, str.lower, str.upper, str.title))(self.of(names))
        name = f"{self.word()}_{name}" if self.number(0, 5) == 0 else name
        sign = self.of(("=", "=", ":", ": ", " = ", " : ", ":  "))
        return self.of(("", "", "\"", "'")) .join((self.of((" ", "\n", " and ", "(")) + name, sign)) + self.of(("", "", "\"", "'"))

    def secret(self) -> tuple[str, str, str]:
        """(before, value, after): a random value anywhere, or a shorter one or a passphrase after a name that calls for it."""
        before, after = self.of(self.contexts)
        way = self.number(0, 9)
        if way < 5:
            before = before if before[-1:].isspace() else before + " "
            if way == 0:   # at the end of a path or address, in one run with it
                before += self.path() + "/"
            return before, self.random_value(18), " " + after.lstrip("\"'")
        before += self.named(SECRET_NAMES)
        return before, self.random_value(10) if way < 8 else self.passphrase(), self.of((" ", "\n", ",", "")) + after

    def harmless(self) -> tuple[str, str, str]:
        before, after = self.of(self.contexts)
        before = self.of((before + " ", before + "\n", before + " (", before + self.named(PLAIN_NAMES), before + self.named(PLAIN_NAMES)))
        # A passphrase is one by its name alone, so what looks like one is harmless elsewhere.
        value = self.people() if self.number(0, 3) == 0 else self.plain()
        return before, value, self.of((" ", ", ", "\n", ") ")) + after

    def plain(self) -> str:
        """Paths, addresses, versions, identifiers, numbers and the like."""
        word, number, of = self.word, self.number, self.of
        digits = lambda low, high: self.chars("0123456789", low, high)
        hexes = lambda n: self.chars(ALPHABETS[0], n, n)
        stem = self.stem
        way = number(0, 19)
        if way < 4:
            return self.path() + of(("", "/", "." + of(ENDINGS), "." + of(ENDINGS)))
        if way == 4:
            return f"//{of(('www.', '', 'api.', 'docs.'))}{stem()}.{of(HOSTS)}/" + "/".join(stem() for _ in range(number(0, 5)))
        if way in (5, 14):
            value = "-".join(hexes(n) for n in (8, 4, 4, 4, 12))
            return of((value, value, value.upper()))
        if way == 6:
            return of(("", "v", word() + "-", word() + "=", "=")) + ".".join(digits(1, 3) for _ in range(number(2, 4))) + of(
                ("", "-" + word() + digits(1, 2), "-SNAPSHOT", ".dev" + digits(1, 2), "-rc." + digits(1, 1)))
        if way == 7:
            return of((digits(8, 20), digits(4, 4) + "-" + digits(4, 4) + "-" + digits(4, 4) + "-" + digits(4, 4),
                       "-".join(digits(2, 5) for _ in range(3)), f"{digits(1, 6)}.{digits(4, 14)}", "+" + digits(9, 14), digits(3, 9) + "e-" + digits(1, 2)))
        if way == 8:
            return of((f"{number(1900, 2100)}-{number(1, 12):02d}-{number(1, 28):02d}", f"{number(1900, 2100)}-{number(1, 12):02d}-{number(1, 28):02d}T{number(0, 23):02d}",
                       ".".join(str(number(0, 255)) for _ in range(4)), f"{number(1, 28):02d}.{number(1, 12):02d}.{number(1900, 2100)}"))
        if way == 9:
            return of(("=", "-", ".", "_", "+", "/")) * number(8, 50) + of(("", digits(1, 1), word()))
        if way == 10:
            return f"{word()}{digits(1, 3)}.{word()}.{of(HOSTS)}"
        if way in (11, 12):
            return digits(8, 20)
        if way == 13:
            return of((str.lower, str.title))(word())
        return self.identifier()

    def stem(self) -> str:
        """A name as files and folders have it."""
        words = self.of(("", "_", "-", ".")).join(self.word() for _ in range(self.number(1, 3)))
        ends = ("", "", self.chars("0123456789", 1, 2), "-" + self.chars("0123456789", 1, 3), f"{self.number(0, 9)}.{self.number(0, 30)}")
        return words + self.of(ends)

    def path(self) -> str:
        parts = [self.stem() for _ in range(self.number(2, 7))]
        if self.number(0, 3) == 0:
            parts.insert(self.number(0, len(parts)), f"{self.number(2000, 2030)}/{self.number(1, 12):02d}/{self.number(1, 28):02d}")
        return self.of(("/", "", "//", "./", "../")) + "/".join(parts)

    def identifier(self) -> str:
        """Words and numbers in one style, as names of things, files and code are written."""
        styles = ((str.lower,), (str.lower,), (str.upper,), (str.title,), (str.lower, str.title), (str.lower, str.upper, str.title))
        style, sign = self.of(styles), self.of(("", "", "_", "_", "-", "-", ".", "/"))
        parts = [self.of(style)(self.word())[:self.of((1, 3, 6, 20))] for _ in range(self.number(1, 5))]
        for _ in range(self.of((0, 0, 1, 1, 2))):
            parts.insert(self.number(0, len(parts)), self.chars("0123456789", 1, self.of((1, 2, 4, 8))))
        return sign.join(parts) + self.of(("", "", "", "." + self.of(ENDINGS)))


def _fits(before: str, value: str, after: str, label: int) -> Iterator[tuple[str, str, str, int]]:
    """A finding in the windows that ``scan`` would see of it; of a secret only those that show enough of it."""
    text, start = before + value + after, len(before)
    for run in candidates(text, []):
        if run[0] < start + len(value) and run[1] > start:
            for s, e in windows(text, *run):
                if not label or min(e, start + len(value)) - max(s, start) >= min(len(value), 16):
                    yield text[max(0, s - BEFORE):s], text[s:e], text[e:e + AFTER], label


def _shown(rows: list[tuple[str, str, str, int]], rng: np.random.Generator, made: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, labels and kinds of findings: as they are, and about ``made`` more of each label with made-up values."""
    words = [w for b, _, a, _ in rows for w in re.findall("[A-Za-z]{3,12}", b + " " + a)][:5000]
    maker = Maker(rng, [(b, a) for b, _, a, y in rows if y != SECRET], words)
    shown = [r for r in rows if r[3] != CONTEXT]
    for make, label in ((maker.secret, 1), (maker.harmless, 0)):
        own: list[tuple[str, str, str, int]] = []
        while len(own) < made:
            own += _fits(*make(), label)
        shown += own
    codes = np.array([encode(b, i, a) for b, i, a, _ in shown])
    return codes, np.array([r[3] for r in shown], np.float32), np.array([kind_of(r[1], r[0]) for r in shown])


def likeness(value: str) -> tuple | None:
    """What values that look alike share: kind, length and sorts of characters, of those that change sort often."""
    sorts = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in value]
    own = [x for x in sorts if x < 3]
    if len(value) < 12 or 5 * sum(a != b for a, b in pairwise(own)) < len(value):
        return None
    return kind_of(value), len(value), frozenset(sorts)


def contexts(text: str, base: list[Span]) -> list[tuple[str, str, str, int]]:
    """(before, nothing, after, CONTEXT) at spaces about ``APART`` characters apart."""
    places = (text.find(" ", k) for k in range(0, len(text), APART))
    return [(text[max(0, k + 1 - BEFORE):k + 1], "", text[k + 1:k + 1 + AFTER], CONTEXT) for k in places if k >= 0]


def taught(rows: list[tuple[str, str, str, int]]) -> list[tuple[str, str, str, int]]:
    """The findings without other candidates that are, or look like, a known secret."""
    known = {i for _, i, _, y in rows if y == SECRET}
    alike = {likeness(i) for i in known} - {None}
    return [r for r in rows if r[3] != OTHER or r[1] not in known and likeness(r[1]) not in alike]


def fit(rows: list[tuple[str, str, str, int]], recall: float = RECALL, seed: int = 5) -> Network:
    """A network from findings (before, inside, after, label); a fifth of them calibrate it.

    Labels are SECRET, OTHER, and CONTEXT for places that show what stands around words. Without a secret the network
    adds nothing.
    """
    rng = np.random.default_rng(seed)
    rows = taught(rows)
    if not any(r[3] == SECRET for r in rows):
        return Network({})
    fold = np.array([hashlib.md5(r[1].encode()).digest()[0] % 5 for r in rows])
    parts = [[r for r, f in zip(rows, fold, strict=True) if keep(f)] for keep in (lambda f: f > 0, lambda f: f == 0)]
    codes, labels, _ = _shown(parts[0], rng, MADE)
    net = Network(_fit_network(codes, labels, rng))
    codes, labels, kinds = _shown(parts[1], rng, MADE // 4)
    net.slope, net.shift = _calibrate(net.raw(codes), labels)
    p = net.probability(codes)

    for k in range(4):
        own = (labels == 1) & (kinds == k)
        if own.sum() < LEAST_HELD:
            own = labels == 1
        # The highest threshold that keeps the recall on held-out secrets.
        net.thresholds[k] = float(np.quantile(p[own], 1 - recall, method="lower"))
    return net


def known_secrets(text: str, base: list[Span]) -> list[tuple[str, str, str, int]]:
    """(before, inside, after, 1) of the base findings' values, in windows."""
    out = []
    for kind, start, end in base:
        if kind == "assign":
            m = BASE[0][1].match(text, start)
            start = m.start(2)
        out += [(text[max(0, s - BEFORE):s], text[s:e], text[e:e + AFTER], 1) for s, e in windows(text, start, end)]
    return out


def other_findings(text: str, base: list[Span]) -> list[tuple[str, str, str, int]]:
    """(before, inside, after, 0) of the other candidates, in windows."""
    return [(text[max(0, s - BEFORE):s], text[s:e], text[e:e + AFTER], 0)
            for run in candidates(text, base) for s, e in windows(text, *run)]


def labelled_findings(text: str) -> list[tuple[str, str, str, int]]:
    """(before, inside, after, label) of the base findings' values and of the other candidates."""
    base = base_spans(text)
    return known_secrets(text, base) + other_findings(text, base)


def train(docs: DataFrame, ident: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS,
          sample_findings: int = SAMPLE_FINDINGS) -> Network:
    """The network from at most ``sample_findings`` findings, chosen by hash: half of them base findings of any document,
    half other candidates of at most ``sample_docs`` documents, chosen by hash too, and half as many contexts of these."""
    chosen = docs.select(F.col(ident).alias("id")).where("id IS NOT NULL").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    texts = docs.select(F.col(ident).alias("id"), text_of(text).alias("text"))
    schema = "before string, inside string, after string, label int"

    def some(texts: DataFrame, findings: Callable) -> list[tuple]:
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces_of(batches, "text"):
                rows = [r for t in strings(batch.column("text")) for r in findings(t, base_spans(t))]
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string()] * 3 + [pa.int32()], strict=True)],
                                          names=["before", "inside", "after", "label"])

        found = texts.select("text").mapInArrow(find, schema).distinct()
        return [tuple(r) for r in found.orderBy(F.xxhash64("before", "inside", "after"), "before", "inside", "after")
                .limit(sample_findings // 2).collect()]

    sample = texts.join(F.broadcast(chosen), "id")
    return fit(sorted(some(texts, known_secrets) + some(sample, other_findings) + some(sample, contexts)))


def scan(text: str, net: Network) -> tuple[list[Span], list[Span]]:
    """The base spans and all spans of a text."""
    base = base_spans(text)
    if not net.parameters:
        return base, base
    over: set[tuple[int, int]] = set()
    parts = ((run, w) for run in candidates(text, base) for w in windows(text, *run))
    while some := list(islice(parts, BATCH)):
        p = net.probability(np.stack([encode_at(text, *w) for _, w in some]))
        over.update(run for (run, (s, e)), x in zip(some, p, strict=True) if x >= net.thresholds[kind_of(text[s:e], text[max(0, s - BEFORE):s])])
    added: list[Span] = [("model", s, e) for s, e in over]
    return base, sorted(base + added, key=lambda s: (s[1], KINDS[s[0]], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_secrets(docs: DataFrame, net: Network, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    rows = docs.select(F.col(ident).alias("doc_id"), text_of(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            out = []
            for t in strings(batch.column("text")):
                base, spans = scan(t, shared.value)
                kinds = [k for k, _, _ in base]
                out.append((*(kinds.count(k) for k, *_ in BASE), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))],
                                  names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return rows.mapInArrow(find, f"doc_id {dict(rows.dtypes)['doc_id']}, n_assign bigint, n_access bigint, n_hex bigint, "
                                 "base_sha256 string, spans string")
