import base64
import hashlib
import random
import re
import uuid

import numpy as np
import pytest

from searchlens.llm import secrets as S

from .edge import SF, TEXTS, edge_docs

PATTERNS = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
             lambda m: len(m[2]) >= 8),
            ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
            ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]


def slow_base(text):
    found = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(PATTERNS) for m in p.finditer(text) if ok(m)]
    return [(name, s, e) for s, k, name, e in sorted(found)]


def test_base_findings():
    rng = random.Random(4)
    parts = ["password", "Token", "API_KEY", "apikey", "secret", "=", ":", " ", "  ", "'", '"', "abc123", "Zz9+/=", "deadbeef" * 5,
             "AKIA", "ABCDEF0123456789", "é", "\n", "0123456789abcdef0123456789abcdef", "K"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert S.base_spans(text) == slow_base(text)


def _rows(rng, n):
    digits = "0123456789abcdef"
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9)))
    out = []
    for _ in range(n):
        words = " ".join(word() for _ in range(4))
        h = "".join(rng.choice(digits) for _ in range(rng.choice([18, 40])))
        key = "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
        out += [(f"{words} password=", h, f" {word()}", 1), (f"{words} ", key, f" {word()}", 1)]
        out += [(f"{words} ", f"{rng.randint(10, 255)}.{rng.randint(10, 255)}.{rng.randint(10, 255)}.{rng.randint(10, 255)}", " a", 0),
                (f"{words} ", str(rng.randint(10**15, 10**16)), " b", 0), ("mail ", f"{word()}.{word()}.{rng.randint(10, 99)}", "@mail", 0)]
    return out


@pytest.fixture(scope="module")
def net():
    return S.fit(_rows(random.Random(1), 150))


LOWER = "abcdefghijklmnopqrstuvwxyz"
SECRETS = {
    "hex": lambda r: r.randbytes(12).hex(),
    "base64": lambda r: base64.b64encode(r.randbytes(30)).decode(),
    "prefixed": lambda r: "ghp_" + "".join(r.choices(LOWER + LOWER.upper() + "0123456789", k=36)),
    "named": lambda r: "pwd=" + "".join(r.choices(LOWER + LOWER.upper() + "0123456789", k=12)),
    "capitals": lambda r: "".join(r.choices(LOWER.upper() + "0123456789", k=20)),
    "passphrase": lambda r: "passphrase: " + "".join(r.sample(["quiet", "falcon", "ladder", "marble", "ocean", "pepper", "violin"], 3)),
}
HARMLESS = {
    "path": lambda r: r.choice(["/usr/local/lib/python3.13/site-packages", "/var/log/nginx/access.log.1", "src/test/java/AppTest1.java",
                                "/opt/conda/envs/py310/bin/python3", "docs/2023/10/weekly-report.html"]),
    "url": lambda r: f"https://www.{r.choice(['wikipedia', 'nytimes', 'stackoverflow'])}.org/{r.choice(['wiki', 'questions', 'articles'])}/"
                     f"{r.choice(['Machine_learning', '12345678', 'how-to-parse-json-in-python3'])}{r.randrange(100)}",
    "uuid": lambda r: str(uuid.UUID(int=r.getrandbits(128))),
    "version": lambda r: r.choice(["numpy-1.26.4", "v2.13.0-rc1", "openjdk-17.0.9", "3.11.4-slim-bookworm"]) + f".{r.randrange(99)}",
    "number": lambda r: "".join(r.choices("0123456789", k=r.randrange(9, 19))),
    "host": lambda r: f"{r.randrange(256)}.{r.randrange(256)}.{r.randrange(256)}.{r.randrange(256)} node{r.randrange(99)}.cluster.local",
}


def _flagged(net, rng, texts, make, times=150):
    """The share of made values, planted into texts, that an added span touches."""
    hits = 0
    for _ in range(times):
        text, value = rng.choice(texts), make(rng)
        at = text.find(" ", rng.randrange(len(text) // 2)) + 1
        planted = text[:at] + value + " " + text[at:]
        hits += any(k == "model" and s < at + len(value) and e > at for k, s, e in S.scan(planted, net)[1])
    return hits / times


@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_planted_secrets_and_harmless_strings(spark, scale):
    """Values of another generator than the one that the network was taught with, in the table's texts."""
    docs = spark.read.parquet(f"{SF.replace('0.001', scale)}/documents.parquet")
    net, rng = S.train(docs), random.Random(11)
    texts = [r["text"] for r in docs.where("length(text) BETWEEN 200 AND 2000").orderBy("doc_id").limit(200).collect()]
    found = {k: _flagged(net, rng, texts, f) for k, f in SECRETS.items()}
    wrong = {k: _flagged(net, rng, texts, f) for k, f in HARMLESS.items()}
    assert min(found.values()) >= 0.9 and max(wrong.values()) <= 0.02, (found, wrong)


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in S._start(rng).items()}
    codes, labels = rng.integers(0, S.SYMBOLS, (6, S.LENGTH)), np.array([0, 1, 0, 1, 1, 0.0])

    def loss(p):
        out = S._forward(p, codes)[0]
        return float(np.mean(np.logaddexp(0, out) - labels * out))

    grad = S._gradient(p, codes, labels)
    for name, x in p.items():
        for _ in range(4):
            at = tuple(int(rng.integers(0, n)) for n in x.shape)
            step = np.zeros_like(x)
            step[at] = 1e-5
            slope = (loss(p | {name: x + step}) - loss(p | {name: x - step})) / 2e-5
            assert abs(slope - grad[name][at]) < 1e-4 + 0.02 * abs(slope), name


def test_added_spans_and_base_spans(net):
    text = "see note 1b7db7aa4a5fcc78305e then password=b7db7aa4a5fcc78305 and mail 42.144.35.254 end"
    base, spans = S.scan(text, net)
    assert base == slow_base(text) and set(base) <= set(spans)
    assert all(text[s:e] == "1b7db7aa4a5fcc78305e" for k, s, e in spans if k == "model")


def _path(rng, least):
    out = ""
    while len(out) < least:
        out += "/" + "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(3, 9)))
    return out + "/"


def test_long_candidates_are_scored_over_their_whole_length(net):
    rng = random.Random(3)
    for least in (50, 150, 3000):
        for k in range(5):
            lead = _path(rng, least)
            text = f"see {lead}{'1b7db7aa4a5fcc78305e'[k:]}f end"
            assert S.scan(text, net)[1] == [("model", 4, len(text) - 4)]
            assert least > 150 or S.scan(f"see {lead}a1 end", net)[1] == []
    for length in (8, 40, 41, 60, 61, 99, 1000):
        own = list(S.windows("x" * 1010, 5, 5 + length))
        assert all(any(s <= k and k + min(20, length) <= e for s, e in own) for k in range(5, 6 + length - min(20, length)))
        assert all(e - s <= S.INSIDE for s, e in own)


def test_every_kind_keeps_its_recall_of_held_out_secrets(monkeypatch):
    held = []
    shown = S._shown
    monkeypatch.setattr(S, "MADE", 2000)
    monkeypatch.setattr(S, "_shown", lambda *a: held.append(shown(*a)) or held[-1])
    monkeypatch.setattr(S, "_fit_network", lambda codes, labels, rng: {"none": np.zeros(1)})
    monkeypatch.setattr(S.Network, "raw", lambda net, codes: np.asarray(codes).sum(1) / 4000)   # scores that say little
    net = S.fit(_rows(random.Random(6), 150))
    codes, labels, kinds = held[-1]
    p = net.probability(codes)
    for k in range(4):
        own = (labels == 1) & (kinds == k)
        assert own.sum() >= S.LEAST_HELD
        assert np.mean(p[own] >= net.thresholds[k]) >= S.RECALL > np.mean(p[own] > net.thresholds[k])


def test_a_kind_with_few_held_out_secrets_takes_the_threshold_of_all(monkeypatch):
    monkeypatch.setattr(S, "MADE", 400)
    monkeypatch.setattr(S, "LEAST_HELD", 10**6)
    monkeypatch.setattr(S, "_fit_network", lambda codes, labels, rng: {"none": np.zeros(1)})
    monkeypatch.setattr(S.Network, "raw", lambda net, codes: np.asarray(codes).sum(1) / 4000)
    assert len(set(S.fit(_rows(random.Random(6), 50)).thresholds)) == 1


def test_secrets_are_taught_in_the_windows_of_the_scan():
    value = "aB3" * 40
    text = "x " * 20 + "password=" + value + " end"
    rows = S.known_secrets(text, S.base_spans(text))
    assert len(rows) > 3 and all(len(i) <= S.INSIDE for _, i, _, _ in rows)
    assert {i for _, i, _, _ in rows} == {text[s:e] for s, e in S.windows(text, text.index(value), text.index(value) + len(value))}
    made = list(S._fits("some words ", "/srv/app/current/config/tokens/ghp_16C7e42F292c6912E7710c838347Ae178B4a", " end", 1))
    assert made and all(len(i) <= S.INSIDE and y == 1 for _, i, _, y in made)
    assert list(S._fits("word ", "lowercaseword", " end", 0)) == []    # no candidate


def test_candidates_like_known_secrets_are_not_taught_as_others():
    secret = ("password=", "1b7db7aa4a5fcc78305e", " end", 1)
    same, alike = ("key ", secret[1], " a", 0), ("key ", "9c0de4f1a2b3c4d5e6f7", " a", 0)
    others = [("", "4785380592391139", "", 0), ("", "70.23.22.57", "", 0), ("", "mail5.example.com", "", 0)]
    assert S.taught([secret, same, alike, *others]) == [secret, *others]


def test_values_of_assignments_are_candidates(net):
    for text, value in (("pwd: correcthorsebattery end", "correcthorsebattery"), ("passphrase = zebraquiltmango", "zebraquiltmango"),
                        ("a client_key=QWERTYUIOPASDF b", "QWERTYUIOPASDF"), ('{"pass" : "zebraquiltmango"}', "zebraquiltmango"),
                        ("é:'allsmallletters'", "allsmallletters"), ("pwd=sevenly", None), (" = zebraquiltmango", None),
                        ("just ordinary sentences of something", None), ("password: zebraquiltmango", None)):
        assert [text[s:e] for s, e in S.candidates(text, S.base_spans(text))] == ([value] if value else []), text
    text = "pwd=zkbdfgcjhkzbdfghkj end"
    assert S.scan(text, net)[1] == [("model", 4, 22)]


def test_without_findings_nothing_is_added():
    empty = S.fit([])
    assert S.scan("aB3dE6gH9jK2 password=b7db7aa4a5fcc78305", empty) == ([("assign", 13, 40)],) * 2


def _check(out, texts):
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], set()).add((r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]))
        base = {x for x in r["spans"].split(",") if x and not x.startswith("model")}
        assert hashlib.sha256(",".join(x for x in r["spans"].split(",") if x in base).encode()).hexdigest() == r["base_sha256"]
    for i, t in texts:
        base = slow_base(t or "")
        sha = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert (*(sum(x[0] == k for x in base) for k in ("assign", "access", "hex")), sha) in got[i]


def test_documents_of_the_table(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    net = S.train(docs)
    out = S.find_secrets(docs, net)
    assert out.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    _check(out, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_rare_secrets_are_learnt_from_all_documents(spark, monkeypatch):
    rng = random.Random(8)
    texts = [f"see 4.{k}.77.{k % 9} and {rng.randint(10**15, 10**16)} end" for k in range(300)]
    for k in range(250, 300):
        texts[k] += " password=" + "".join(rng.choice("0123456789abcdef") for _ in range(20))
    docs = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "doc_id string, text string")
    seen = []
    monkeypatch.setattr(S, "fit", lambda rows: seen.append(rows))
    S.train(docs, sample_docs=10)
    labels = [[r[3] for r in rows] for rows in seen]
    assert labels[0].count(S.SECRET) == 50 and 0 < labels[0].count(S.OTHER) <= 20 and 0 < labels[0].count(S.CONTEXT) <= 20
    S.train(docs, sample_docs=10, sample_findings=60)
    assert [r[3] for r in seen[1]].count(S.SECRET) == 30


def test_awkward_documents(spark):
    docs = edge_docs(spark)
    _check(S.find_secrets(docs, S.train(docs)), TEXTS)
    assert S.find_secrets(docs.limit(0), S.train(docs.limit(0))).count() == 0
