"""Personal data: patterns, and a skip-chain conditional random field over their tokens.

Patterns find e-mail, IP, card and phone spans.  The tokens of a document that
hold a digit or an @ (others can't be part of these) form a graph: neighbours
are linked in a chain, and a token is linked to the last one before it that is
the same or similar (equal last digits).  Labels of linked tokens share
potentials, so what is labelled in one place pulls its other mentions along.
Weights are learned by pseudo-likelihood from a bounded sample of documents that
the patterns label; loopy sum-product gives each token's marginals.  Tokens in
pattern spans are observed.  The field adds spans; those of the patterns stay.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.shared import batch_of, map_batches, pick
from dimforge.llm.shingles import text_chunks

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)                 # the label of all else
LABELS = OTHER + 1
SAMPLE_DOCUMENTS = 3000            # learned from, the lowest hashes of doc_id among documents with a digit or @
SAMPLE_ROWS = 200_000              # different labelled tokens learned from, the lowest hashes if there are more
ROUNDS = 12                        # of message passing
SURE = 0.9                         # least marginal probability of an added token
SIMILAR_DIGITS = 7                 # tokens with so many equal last digits are similar

AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"[^ \t-\r]+")
DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @: the local part is what may stand before it, back to the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = AT.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)  # no local part reaches over an @
        at = text.find("@", max(done, at + 1))
    return out


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    spans = [(0, a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split(".")):
            spans.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            spans.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= sum(map(len, DIGITS.findall(m[0]))) <= 15:
            spans.append((3, *m.span()))
    return spans


def tokens_of(text: str) -> list[tuple[int, int, int]]:
    """(start, end, number of the word) of the words with a digit or an @."""
    out = []
    for i, m in enumerate(TOKEN.finditer(text)):
        word = m[0]
        if not word.isalpha() and ("@" in word or DIGITS.search(word)):
            out.append((m.start(), m.end(), i))
    return out


def _bucket(n: int) -> str:
    return "0" if n == 0 else "1-3" if n < 4 else "4-6" if n < 7 else "7-8" if n < 9 else "9-12" if n < 13 \
        else "13-19" if n < 20 else "20+"


def features(word: str) -> list[str]:
    digits = "".join(DIGITS.findall(word))
    shape = re.sub(r"9+", "9", re.sub(r"a+", "a", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", word[:64]))))
    out = ["bias", f"digits={_bucket(len(digits))}", f"dots={min(word.count('.'), 4)}", f"shape={shape[:12]}"]
    out += [f"has={c}" for c in "@+(-" if c in word]
    if re.search(r"[^\W\d_]", word):
        out.append("letters")
    if 13 <= len(digits) <= 19:
        out.append(f"luhn={luhn(digits)}")
    return out


def skip_key(word: str) -> str:
    digits = "".join(DIGITS.findall(word))
    return digits[-SIMILAR_DIGITS:] if len(digits) >= SIMILAR_DIGITS and "@" not in word else word.strip(".,;:!?()<>\"'").lower()


def graph_of(text: str, spans: list[tuple[int, int, int]]):
    """Tokens, their pattern labels (OTHER if none), chain links and skip links (index pairs)."""
    tokens = tokens_of(text)
    label = [OTHER] * len(tokens)
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        lo, hi = 0, len(tokens)
        while lo < hi:  # first token that ends behind the span's start
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if tokens[mid][1] <= a else (lo, mid)
        while lo < len(tokens) and tokens[lo][0] < b:
            if label[lo] == OTHER:
                label[lo] = kind
            lo += 1
    chain = [(i - 1, i) for i in range(1, len(tokens)) if tokens[i][2] == tokens[i - 1][2] + 1]
    last: dict[str, int] = {}
    skip = []
    for i, (a, b, _) in enumerate(tokens):
        key = skip_key(text[a:b])
        if key in last and (not chain or last[key] != i - 1 or tokens[i][2] != tokens[i - 1][2] + 1):
            skip.append((last[key], i))
        last[key] = i
    return tokens, label, chain, skip


# --- learning ------------------------------------------------------------------------------------

_LABELLED = "features array<string>, label int, before int, after int, same array<int>"
_TRAIN = pa.schema([("features", pa.list_(pa.string())), ("label", pa.int32()), ("before", pa.int32()),
                    ("after", pa.int32()), ("same", pa.list_(pa.int32())), ("n", pa.int64())])


def _training_rows(batches):
    """The labelled tokens of whole texts; equal ones of a text are one row with their number."""
    for batch in batches:
        for text in batch.column(0).to_pylist():
            tokens, label, chain, skip = graph_of(text, pattern_spans(text))
            before, after, same = {}, {}, {}
            for i, j in chain:
                after[i], before[j] = label[j], label[i]
            for i, j in skip:
                same.setdefault(i, []).append(label[j])
                same.setdefault(j, []).append(label[i])
            rows = Counter((tuple(features(text[a:b])), label[i], before.get(i, -1), after.get(i, -1),
                            tuple(sorted(same.get(i, ())))) for i, (a, b, _) in enumerate(tokens))
            if rows:
                yield batch_of(_TRAIN, *zip(*rows, strict=True), list(rows.values()))


def learn(rows: list, steps: int = 300, rate: float = 0.5, decay: float = 1e-3) -> dict | None:
    """Weights by pseudo-likelihood: each label given its token and its neighbours' labels.

    ``rows``: (features, label, label before, label after, labels of the same or
    similar tokens, number of such tokens).  The features of all rows stand in one
    array of indexes, so memory goes with their number, not with that of names.
    """
    if not rows:
        return None
    names = {n: k for k, n in enumerate(sorted({n for r in rows for n in r[0]}))}
    index = np.array([names[n] for r in rows for n in r[0]], np.int64)
    size = np.array([len(r[0]) for r in rows])
    begin, owner = np.cumsum(size) - size, np.repeat(np.arange(len(rows)), size)
    before, after, same = (np.zeros((len(rows), LABELS)) for _ in range(3))
    y = np.array([r[1] for r in rows])
    for i, (_, _, b, a, s, _) in enumerate(rows):
        if b >= 0:
            before[i, b] = 1
        if a >= 0:
            after[i, a] = 1
        for k in s:
            same[i, k] += 1
    share = np.array([r[5] for r in rows], float)[:, None]
    share *= LABELS / share.sum()
    truth = np.eye(LABELS)[y]
    unary, chain, skip = np.zeros((len(names), LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS)
    for _ in range(steps):
        z = np.add.reduceat(unary[index], begin) + before @ chain + after @ chain.T + same * skip
        z = np.exp(z - z.max(axis=1, keepdims=True))
        gap = (truth - z / z.sum(axis=1, keepdims=True)) * share
        pull = np.stack([np.bincount(index, gap[owner, k], len(names)) for k in range(LABELS)], axis=1)
        unary += rate * (pull - decay * unary)
        chain += rate * (before.T @ gap + (after.T @ gap).T - decay * chain)
        skip += rate * ((same * gap).sum(axis=0) - decay * skip)
    return {"names": names, "unary": unary, "chain": chain, "skip": np.diag(np.maximum(skip, 0))}


def train(documents: DataFrame) -> dict | None:
    """Learn the field from the whole texts of at most SAMPLE_DOCUMENTS documents of ``documents(doc_id, text)``.

    Equal labelled tokens are counted before they reach the driver, which gets at
    most SAMPLE_ROWS different ones.
    """
    docs = pick(documents, doc_id="long", text="string").where(F.col("text").rlike("[0-9@]"))
    hashed = docs.withColumn("h", F.xxhash64("doc_id"))
    limit = hashed.select("h").orderBy("h").limit(SAMPLE_DOCUMENTS).agg(F.max("h")).first()[0]
    if limit is None:
        return None
    sample = hashed.where(F.col("h") <= limit).limit(SAMPLE_DOCUMENTS).select("text")
    labelled = ["features", "label", "before", "after", "same"]
    rows = (map_batches(sample, _training_rows, f"{_LABELLED}, n long").groupBy(*labelled).agg(F.sum("n").alias("n"))
            .orderBy(F.xxhash64(*labelled), *labelled).limit(SAMPLE_ROWS))
    return learn([tuple(r) for r in rows.collect()])


# --- inference -----------------------------------------------------------------------------------

def marginals(unary: np.ndarray, links: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Loopy sum-product.  ``links``: (from nodes, to nodes, log potentials[from label, to label])."""
    messages = [(np.zeros((len(i), LABELS)), np.zeros((len(i), LABELS))) for i, _, _ in links]

    def belief():
        out = unary.copy()
        for (i, j, _), (to_j, to_i) in zip(links, messages, strict=True):
            np.add.at(out, j, to_j)
            np.add.at(out, i, to_i)
        return out

    def sent(cavity, potential):
        z = cavity[:, :, None] + potential[None]
        top = z.max(axis=1, keepdims=True)
        m = np.log(np.exp(z - top).sum(axis=1)) + top[:, 0]
        return m - m.max(axis=1, keepdims=True)

    for _ in range(ROUNDS if any(len(i) for i, _, _ in links) else 0):
        b = belief()
        messages = [(0.5 * to_j + 0.5 * sent(b[i] - to_i, p), 0.5 * to_i + 0.5 * sent(b[j] - to_j, p.T))
                    for (i, j, p), (to_j, to_i) in zip(links, messages, strict=True)]
    b = belief()
    b = np.exp(b - b.max(axis=1, keepdims=True))
    return b / b.sum(axis=1, keepdims=True)


def _added(texts: list[str], graphs: list, model: dict) -> list[list[tuple[int, int, int]]]:
    """Spans that the field adds in each text."""
    names, rows, observed, chain, skip, offset = model["names"], [], [], [], [], 0
    for text, (tokens, label, c, s) in zip(texts, graphs, strict=True):
        for (a, b, _), y in zip(tokens, label, strict=True):
            rows.append([names[f] for f in features(text[a:b]) if f in names])
            observed.append(y)
        chain += [(i + offset, j + offset) for i, j in c]
        skip += [(i + offset, j + offset) for i, j in s]
        offset += len(tokens)
    unary = np.array([model["unary"][r].sum(axis=0) for r in rows]).reshape(-1, LABELS)
    seen = np.array(observed) != OTHER
    unary[seen] = -50.0
    unary[seen, np.array(observed)[seen]] = 0.0
    ends = [np.array(x, np.int64).reshape(-1, 2).T for x in (chain, skip)]
    p = marginals(unary, [(*ends[0], model["chain"]), (*ends[1], model["skip"])])
    out, offset = [], 0
    for text, (tokens, label, _, _) in zip(texts, graphs, strict=True):
        spans: list[tuple[int, int, int]] = []
        for k, (a, b, word) in enumerate(tokens):
            mine = p[offset + k]
            if label[k] == OTHER and 1 - mine[OTHER] >= SURE:
                core = text[a:b]
                a += len(core) - len(core.lstrip(".,;:!?[]{}<>\"'"))
                b -= len(core) - len(core.rstrip(".,;:!?[]{}<>\"'"))
                kind = int(mine[:OTHER].argmax())
                joins = spans and spans[-1][0] == kind and k and tokens[k - 1][2] == word - 1 and spans[-1][2] <= a \
                    and not text[spans[-1][2]:a].strip()
                if joins:
                    spans[-1] = (kind, spans[-1][1], b)
                elif a < b:
                    spans.append((kind, a, b))
        out.append(spans)
        offset += len(tokens)
    return out


def _listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


_FOUND = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
                    ("spans", pa.string()), ("n_added", pa.int64())])


def find_all(texts: list[str], model: dict | None) -> list[tuple[list, list]]:
    """Pattern spans and added spans of each text."""
    base = [pattern_spans(t) for t in texts]
    if model is None:
        return [(b, []) for b in base]
    graphs = [graph_of(t, b) for t, b in zip(texts, base, strict=True)]
    some = [i for i, g in enumerate(graphs) if g[0]]
    added: list[list] = [[] for _ in texts]
    if some:
        for i, spans in zip(some, _added([texts[i] for i in some], [graphs[i] for i in some], model), strict=True):
            added[i] = spans
    return list(zip(base, added, strict=True))


def masked(text: str, spans) -> str:
    """The text with every span (joined where they overlap) replaced by its kind in angle brackets."""
    out, at = [], 0
    merged: list[list[int]] = []
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([k, a, b])
    for k, a, b in merged:
        out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = b
    return "".join([*out, text[at:]])


def _search(model):
    def run(batches):
        field = model.value
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            for a, b in text_chunks(batch.column(1), 500_000):
                text = pc.fill_null(batch.column(1).slice(a, b - a), "")
                some = np.flatnonzero(pc.match_substring_regex(text, "[0-9@]").to_numpy(zero_copy_only=False))
                rows = [(0, 0, 0, 0, nothing, "", 0)] * (b - a)
                texts = text.take(pa.array(some)).to_pylist()
                for i, (base, added) in zip(some.tolist(), find_all(texts, field), strict=True):
                    n = [sum(s[0] == k for s in base) for k in range(OTHER)]
                    rows[i] = (*n, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(base + added), len(added))
                yield batch_of(_FOUND, batch.column(0).slice(a, b - a), *zip(*rows, strict=True))
    return run


def find_personal_data(documents: DataFrame) -> DataFrame:
    """``documents(doc_id, text)`` -> a row for each input row: counts, digest and list of spans.

    Columns: doc_id, n_email, n_ip, n_card, n_phone (pattern spans), base_sha256
    (of the pattern spans), spans (all, as kind:start:end in code points) and
    n_added (by the field).  Null text is empty and has none; repeated rows are
    treated alike; without any labelled token the patterns stand alone.  Other
    columns are ignored.
    """
    model = documents.sparkSession.sparkContext.broadcast(train(documents))
    fields = ", ".join(["doc_id long", *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string",
                        "n_added long"])
    return map_batches(pick(documents, doc_id="long", text="string"), _search(model), fields)


def _mask(model):
    def run(batches):
        field = model.value
        for batch in batches:
            names = batch.schema.names
            at = names.index("text")
            for a, b in text_chunks(batch.column(at), 500_000):
                part = batch.slice(a, b - a)
                column = part.column(at)
                some = np.flatnonzero(pc.fill_null(pc.match_substring_regex(column, "[0-9@]"), False)
                                      .to_numpy(zero_copy_only=False))
                if not len(some):
                    yield part
                    continue
                texts, changed = column.to_pylist(), {}
                for i, (base, added) in zip(some.tolist(), find_all([texts[i] for i in some], field), strict=True):
                    if base or added:
                        changed[i] = texts[i] = masked(texts[i], base + added)
                arrays = list(part.columns)
                arrays[at] = pa.array(texts, type=column.type)
                if "n_chars" in names and changed:
                    sizes = part.column(names.index("n_chars")).to_pylist()
                    for i, t in changed.items():
                        sizes[i] = len(t)
                    arrays[names.index("n_chars")] = pa.array(sizes, type=part.column(names.index("n_chars")).type)
                yield pa.RecordBatch.from_arrays(arrays, schema=part.schema)
    return run


def mask_personal_data(documents: DataFrame) -> DataFrame:
    """All rows and columns of ``documents``, with every span in ``text`` replaced by ``<KIND>``.

    ``n_chars``, if there is such a column, follows.  Null text stays null.
    """
    model = documents.sparkSession.sparkContext.broadcast(train(documents))
    return map_batches(documents, _mask(model), documents.schema)
