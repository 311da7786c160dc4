"""Secret scans: wide candidate search, then a random forest against false positives.

Candidates are values assigned to credential-like names, strings of known
credential formats and long runs of token characters with digits.  The forest
judges each by its length, character transitions, dictionary coverage, path
and neighbouring words.  The dictionary is the corpus's own: the words that
stand in most documents.  The forest is trained here, on labelled findings
that :func:`labelled_findings` writes from a fixed seed (the corpus labels
none).
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
import math
import random
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.llm.common import table, text_of

THRESHOLD, MASK = 0.5, "[SECRET]"
TREES, DEPTH, LEAF, FINDINGS, SEED = 40, 9, 2, 3000, 5

_RUN = re.compile(r"[A-Za-z0-9_+/=.\-]{16,}")
_ASSIGNS = re.compile(r"[:=]\s{0,3}[\"'`]?(?=[^\s\"'`<>]{8})")
_VALUE = re.compile(r"[^\s\"'`<>]+")
#: Where a value in a query or connection string ends: another assignment follows.
_NEXT = re.compile(r"[&;,](?=[\w.\-%\[\]]{1,40}[:=])")
_NAME = re.compile(r"(?:token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|credentials?|auth|bearer|private[_-]?key)[\w\-]{0,12}[\"'`]?\s{0,3}$", re.I)
_NAME_REACH, _NEAR = 48, 40
_KNOWN = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_\-]{35}|[sr]k_(?:live|test)_[0-9A-Za-z]{16,}|eyJ[\w\-]{10,}\.[\w\-]{10,}\.[\w\-]{10,}")
#: From a key block's first line to its last, headers (Proc-Type, DEK-Info) included.
_KEY_BLOCK = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?)-----(?:(?!-----)[\s\S]){16,}-----END \1-----")
_HARMLESS = re.compile(r"commit|sha\d*|md5|checksum|digest|hash|uuid|guid|integrity|example|sample|dummy|placeholder|version|path|file|image|base64|isbn|phone|revision|color", re.I)
_HINT = re.compile(r"token|secret|passw|pwd|api|key|auth|bearer|credential|login|private", re.I)
#: Pieces of names that the labelled findings are written with; they stand in every dictionary.
PIECES = (
    "access account array auth base cache client code color commit config content count data date debug default device domain email error event example "
    "file format function group handle hash header home host html image index input item json label lang layer library line link list load local login main "
    "manager master media message meta method model module month name network note null number object option order output package page param part pass path "
    "pattern place plugin point port private process profile project public python query random record release remote report request resource response "
    "result root route sample schema script search secret section select server service session setting simple size source space stage state status storage "
    "stream string style system table target task team template test text theme thread time title token total tree type unit update upload user value "
    "version video view week width window word work world write year your zone "
).split()
#: Words of a dictionary taken from a corpus (those in most documents), the least share of its documents that a word stands in (so that
#: what is ranked has a bounded size, whatever the input), and the words' lengths.
DICTIONARY_WORDS, DICTIONARY_SHARE, SHORTEST, LONGEST = 20_000, 1e-3, 4, 12


class Dictionary:
    """Words by length, for :meth:`coverage`."""

    def __init__(self, words: Iterable[str] = ()):
        self.words = frozenset(words) | frozenset(PIECES)

    def coverage(self, value: str) -> float:
        """Share of the letters that stand in words, longest first."""
        low, covered, i = value.lower(), 0, 0
        letters = sum(c.isalpha() for c in low)
        while i < len(low):
            n = next((n for n in range(min(LONGEST, len(low) - i), 2, -1) if low[i : i + n] in self.words), 0)
            covered += n
            i += n or 1
        return covered / letters if letters else 0.0


def dictionary(docs: DataFrame, most: int = DICTIONARY_WORDS) -> Dictionary:
    """The ``most`` words that stand in most documents, over all of ``docs``; ties by the word.

    Words of a single document, or of under a thousandth of all, are left out.
    """
    found = F.array_distinct(F.regexp_extract_all(F.lower(text_of()), F.lit(rf"\b[a-z]{{{SHORTEST},{LONGEST}}}\b"), 0))
    counted = docs.select(F.explode(found).alias("word")).groupBy("word").count().where(F.col("count") >= max(2, docs.count() * DICTIONARY_SHARE))
    return Dictionary(r["word"] for r in counted.orderBy(F.desc("count"), "word").limit(most).collect())


def candidates(text: str, start: int = 0, stop: int | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind), in order, none overlapping another.

    Key blocks win over assigned values, outer ones over those inside them,
    those over known formats, those over plain runs.  With ``start`` and
    ``stop``: what an assigned value holds besides itself.
    """
    whole = (start, stop)
    stop = len(text) if stop is None else stop
    found: list[tuple[int, int, str]] = []

    def add(a: int, z: int, kind: str) -> None:
        i = bisect.bisect(found, (a, z))
        if (not i or found[i - 1][1] <= a) and (i == len(found) or z <= found[i][0]):
            found.insert(i, (a, z, kind))

    if "-----BEGIN" in text:
        for m in _KEY_BLOCK.finditer(text, start, stop):
            add(*m.span(), "key block")
    past = start
    for m in _ASSIGNS.finditer(text, start, stop):
        a = m.end()
        if a >= past and _NAME.search(text, max(start, m.start() - _NAME_REACH), m.start()):
            z = _VALUE.match(text, a, stop).end()
            cut = _NEXT.search(text, a, z)
            z = a + len(text[a : cut.start() if cut else z].rstrip(".,;:!?)]}"))
            if z - a >= 8:
                add(a, z, "assigned")
                past = z
    for m in _RUN.finditer(text, start, stop):
        run = m.group()
        if known := list(_KNOWN.finditer(run)):
            for k in known:
                add(m.start() + k.start(), m.start() + k.end(), "known format")
        elif any(c.isdigit() for c in run):
            run = run.rstrip(".=-/") if not run.endswith("==") else run
            if len(run) >= 16 and (m.start(), m.start() + len(run)) != whole:
                add(m.start(), m.start() + len(run), "run")
    return found


def _kinds(value: str) -> list[int]:
    return [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in value]


def describe(text: str, start: int, end: int, kind: str, words: Dictionary) -> list[float]:
    """The features of one candidate."""
    v = text[start:end]
    n, k = len(v), _kinds(v)
    share = [k.count(i) / n for i in range(4)]
    moves = [0] * 16
    for a, b in zip(k, k[1:], strict=False):
        moves[4 * a + b] += 1
    moves_ = [m / max(1, n - 1) for m in moves]
    counts = [v.count(c) / n for c in set(v)]
    entropy = -sum(p * math.log2(p) for p in counts)
    vowels = sum(c in "aeiouAEIOU" for c in v)
    letters = sum(c.isalpha() for c in v)
    consonants = max((len(x) for x in re.findall(r"[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z]+", v)), default=0)
    left, right = text[max(0, start - _NEAR) : start], text[end : end + _NEAR]
    return [
        math.log2(n), *share, *moves_, entropy, entropy / math.log2(max(2, n)), vowels / max(1, letters), consonants, words.coverage(v),
        float(all(c in "0123456789abcdefABCDEF" for c in v)), v.count("-") / n, v.count("/") / n, v.count(".") / n, v.count("_") / n,
        max(counts), float(left[-1:] in "/\\."), float("://" in left[-16:] + v), float(left[-1:] in "\"'`" and right[:1] in "\"'`"),
        float(bool(_NAME.search(left.rstrip("\"'`: =\t") if kind != "assigned" else "token"))), float(bool(_HINT.search(left))), float(bool(_HARMLESS.search(left))), float(bool(_HARMLESS.search(v))),
        float(kind == "known format"), float(kind == "key block"),
    ]


def labelled_findings(words: Dictionary, n: int = FINDINGS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of ``n`` findings written for training."""
    r = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    pick = lambda alphabet, a, b: "".join(r.choice(alphabet) for _ in range(r.randint(a, b)))
    alnum = letters + letters.upper() + "0123456789"
    hex_ = lambda a, b: pick("0123456789abcdef", a, b)
    word = lambda: r.choice(PIECES)
    prose = lambda: " ".join(pick("etaoinshrdlu", 2, 9) for _ in range(r.randint(2, 6)))
    b64 = lambda a, b: base64.b64encode(r.randbytes(r.randint(a, b))).decode()
    known = (
        lambda: "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16, 16), lambda: "ghp_" + pick(alnum, 36, 36), lambda: "xoxb-" + pick("0123456789", 10, 12) + "-" + pick(alnum, 24, 24),
        lambda: "sk_live_" + pick(alnum, 24, 32), lambda: "AIza" + pick(alnum, 35, 35), lambda: "eyJ" + pick(alnum, 20, 60) + ".eyJ" + pick(alnum, 40, 160) + "." + pick(alnum + "-_", 43, 43),
        lambda: "-----BEGIN RSA PRIVATE KEY-----\n" + r.choice(("", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + hex_(32, 32).upper() + "\n\n")) + b64(200, 600) + "\n-----END RSA PRIVATE KEY-----",
    )
    secret = (
        lambda: hex_(32, 64), lambda: pick(alnum, 20, 48), lambda: pick(alnum + "-_", 24, 64), lambda: b64(18, 48),
        lambda: pick(alnum + "!@#$%^&*", 8, 20), lambda: "".join(r.choice((word, lambda: pick("etaoinshrdlu", 4, 8)))() for _ in range(r.randint(3, 5))) + pick("0123456789", 0, 2), *known,
    )
    names = ("token", "api_key", "apikey", "secret", "password", "client_secret", "access_key", "auth_token", "API-KEY", "TOKEN", "SECRET_KEY", "private_key", "passwd")
    forms = ('{n} = "{v}"', "{n}={v}", "{n}: {v}", '"{n}": "{v}"', "{n} = '{v}'", "Authorization: Bearer {v}", "{n} := {v}", "export {n}={v}", "host=db:5432;{n}={v};ssl=on", "https://api.test/cb?{n}={v}&id=7")
    harmless = (
        lambda: "commit " + hex_(40, 40), lambda: "sha256:" + hex_(64, 64), lambda: "checksum " + hex_(32, 32), lambda: "uuid " + str(uuid.UUID(int=r.getrandbits(128))),
        lambda: "/".join(["/usr", word(), word() + str(r.randint(1, 99)), word(), word() + ".py"]), lambda: f"https://www.{word()}.org/{word()}/{r.randint(1, 9999)}/{word()}-{word()}.html",
        lambda: "-".join(word() for _ in range(r.randint(3, 6))) + "-" + str(r.randint(1, 2030)), lambda: "_".join(word() for _ in range(r.randint(3, 6))) + str(r.randint(0, 9)),
        lambda: f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}T{r.randint(10, 23)}:{r.randint(10, 59)}:00.000Z", lambda: "+" + "-".join(str(r.randint(100, 9999)) for _ in range(4)),
        lambda: "data:image/png;base64," + b64(60, 200), lambda: word() + word().title() + word().title() + str(r.randint(1, 999)) + word().title(),
        lambda: r.choice(names) + " = your_" + word() + "_" + word() + "_here_" + str(r.randint(1, 99)), lambda: r.choice(names) + "=" + r.choice("x*0") * r.randint(10, 40),
        lambda: r.choice(names) + ": " + r.choice(("example", "changeme", "placeholder", "undefined", "required")) + word() + str(r.randint(1, 99)), lambda: r.choice(names) + " = os.environ['" + word().upper() + "_" + word().upper() + "']",
        lambda: r.choice(names) + " = config.get_" + word() + "_" + word() + "()", lambda: "author: " + pick("etaoinshrdlu", 8, 16), lambda: word() + "." * r.randint(3, 9) + word() + "=" * r.randint(8, 30) + str(r.randint(1, 99)),
        lambda: "phone: " + "".join(r.choice("0123456789") for _ in range(r.randint(16, 20))), lambda: f"v{r.randint(1, 9)}.{r.randint(0, 99)}.{r.randint(0, 99)}-{word()}.{r.randint(1, 99)}-{word()}", lambda: "ISBN 978-" + "-".join(str(r.randint(10, 9999)) for _ in range(4)),
    )
    x, y = [], []
    while len(y) < n:
        label = r.random() < 0.5
        body = r.choice(harmless)() if not label else r.choice(known)() if r.random() < 0.2 else r.choice(forms).format(n=r.choice(names), v=r.choice(secret)())
        if r.random() < 0.15 and "PRIVATE KEY" not in body:
            body = body.upper()
        text = f"{prose()} {body}{r.choice(('', ' ', '.', '!!', chr(10)))} {prose()}"
        for a, z, kind in candidates(text):
            x.append(describe(text, a, z, kind, words))
            y.append(int(label))
    return np.array(x[:n]), np.array(y[:n])


class Forest:
    """Binary random forest: bootstrapped Gini trees over random feature subsets."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.trees = []
        for _ in range(trees):
            rows = rng.integers(0, len(y), len(y))
            nodes: list[tuple] = []
            self._grow(x[rows], y[rows], depth, rng, nodes)
            self.trees.append(tuple(np.array(c) for c in zip(*nodes, strict=True)))

    def _grow(self, x, y, depth, rng, nodes) -> int:
        at = len(nodes)
        nodes.append((-1, 0.0, at, at, float(y.mean())))
        if depth == 0 or len(y) < 2 * LEAF or y.min() == y.max():
            return at
        best = (np.inf, None, None)
        for f in rng.choice(x.shape[1], max(1, int(x.shape[1] ** 0.5)), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            n = np.arange(1, len(y) + 1)
            p, q = ones / n, (ones[-1] - ones) / np.maximum(1, len(y) - n)
            cost = n * p * (1 - p) + (len(y) - n) * q * (1 - q)
            cost[:-1][v[1:] == v[:-1]] = np.inf
            cost[: LEAF - 1] = cost[len(y) - LEAF :] = np.inf
            i = int(cost.argmin())
            if cost[i] < best[0]:
                best = (cost[i], f, (v[i] + v[i + 1]) / 2)
        if best[1] is None:
            return at
        left = x[:, best[1]] <= best[2]
        a = self._grow(x[left], y[left], depth - 1, rng, nodes)
        b = self._grow(x[~left], y[~left], depth - 1, rng, nodes)
        nodes[at] = (int(best[1]), float(best[2]), a, b, nodes[at][4])
        return at

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[at]
                at = np.where(f < 0, at, np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= cut[at], left[at], right[at]))
            total += value[at]
        return total / len(self.trees)


class Judge:
    """A forest and the dictionary that its features rest on."""

    def __init__(self, words: Dictionary):
        self.words, self.forest = words, Forest(*labelled_findings(words))

    def score(self, text: str, found: list[tuple[int, int, str]]) -> np.ndarray:
        return self.forest.score(np.array([describe(text, *c, self.words) for c in found]))


@functools.lru_cache(maxsize=4)
def _judge(words: frozenset) -> Judge:
    return Judge(Dictionary(words))


def judge(docs: DataFrame | None = None) -> Judge:
    """Trained with the dictionary of ``docs``, on the driver: at most ``FINDINGS`` findings, whatever the input."""
    return _judge((Dictionary() if docs is None else dictionary(docs)).words)


def findings(text: str, model: Judge) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of each candidate; a score of at least ``THRESHOLD`` makes it a secret.

    An assigned value that is no secret gives way to the candidates inside it.
    """
    out, found = [], candidates(text)
    while found:
        scores = model.score(text, found)
        inside = []
        for c, s in zip(found, scores, strict=True):
            held = candidates(text, c[0], c[1]) if c[2] == "assigned" and s < THRESHOLD else []
            inside += held
            if not held:
                out.append((*c, float(s)))
        found = inside
    return sorted(out)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, start, length, kind, secret_sha256, score, secret of each candidate.

    Positions are code points from 0; the secret itself is given as its hash
    only.  Null texts have none; very long texts and candidates are judged
    whole; null ids stay null; repeated rows give repeated results; an empty
    table gives none; other columns are not read.  A name counts where it ends
    within ``_NAME_REACH`` characters before its separator, and the words
    within ``_NEAR`` characters of a candidate are its neighbours.
    """
    model = docs.sparkSession.sparkContext.broadcast(judge(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, rows = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                for a, z, kind, score in findings(text, model.value):
                    of.append(i)
                    rows.append((a, z - a, kind, hashlib.sha256(text[a:z].encode("utf-8", "surrogatepass")).hexdigest(), score))
            start, length, kind, sha, score = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(of, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(kind, pa.string()), pa.array(sha, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "start", "length", "kind", "secret_sha256", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    out = rows.mapInArrow(run, "doc_id long, start long, length long, kind string, secret_sha256 string, score double")
    return out.withColumn("secret", F.col("score") >= THRESHOLD)


def masked(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """``docs`` with each secret in a text replaced by ``mask``; n_chars follows the text.

    Null texts stay null and empty ones empty; very long texts are searched
    whole; repeated rows stay repeated; an empty table stays empty; other
    columns, whatever their names, are kept as they are.
    """
    model = docs.sparkSession.sparkContext.broadcast(judge(docs))
    at = docs.columns.index("text")

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        for a, z, _, score in reversed(findings(text, model.value)):
            if score >= THRESHOLD:
                text = text[:a] + mask + text[z:]
        return text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pa.array([clean(t) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:at], text, *b.columns[at + 1 :]], b.schema.names)

    out = docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
