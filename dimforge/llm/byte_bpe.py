"""Byte-level BPE: encoding by longest matches and backtracking, and decoding.

The pieces that the tokenizer's pattern cuts are encoded separately.  A piece's
bytes, as Latin-1 characters, go through an Aho-Corasick automaton of all
tokens, which gives the longest token at every position.  Tokens are then taken
from left to right; a token may follow another only if merging their bytes alone
gives just these two, which is enough for the whole piece to be what the merges
give.  Where nothing fits, a shorter token is tried, then the token before; a
position that was left so is never entered again, so time is linear.
"""

from __future__ import annotations

import base64
import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from dimforge.llm.shared import batch_of, pick
from dimforge.llm.shingles import text_chunks

LONGEST_KEPT = 64          # characters of a piece whose ids a task remembers
KEPT_PIECES = 400_000      # pieces it remembers at once
PART_CHARACTERS = 200_000  # of a text whose pieces are listed at once, about
FITTING_PAIRS = 1 << 18    # remembered pairs of adjacent tokens


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (a line each: base64, rank), in the order of their ranks 0, 1, 2 ..."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, f))}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2 and so on")
    return [ranks[i] for i in range(len(ranks))]


def merge_all(text: bytes, rank_of: dict[bytes, int]) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
    """The merges by definition: the pair of lowest rank first, the left one of equal ones; and the last pair merged."""
    parts, last = [text[i:i + 1] for i in range(len(text))], None
    while len(parts) > 1:
        rank, i = min((rank_of.get(a + b, len(rank_of)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == len(rank_of):
            break
        last = (parts[i], parts[i + 1])
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts, last


def last_merges(tokens: list[bytes]) -> list[tuple[int, int] | None]:
    """For each token the two it is merged from: (-1, -1) for a byte, None if merges never give it."""
    rank_of = {t: i for i, t in enumerate(tokens)}
    if any(bytes([b]) not in rank_of for b in range(256)):
        raise ValueError("every byte must be a token")
    out: list[tuple[int, int] | None] = []
    for rank, token in enumerate(tokens):
        if len(token) == 1:
            out.append((-1, -1))
            continue
        parts, last = merge_all(token, rank_of)
        if parts != [token]:
            out.append(None)
            continue
        pair = (rank_of[last[0]], rank_of[last[1]])
        if any(len(part) > 1 and r > rank for part, r in zip(last, pair, strict=True)):
            raise ValueError("a token must rank behind those it is merged from")
        out.append(pair)
    return out


OTHER = "[^\\s\\p{L}\\p{N}]"


@functools.lru_cache(maxsize=4)
def patterns(pattern: str) -> tuple[str, str, str]:
    """The pattern as Python's ``re`` can run it, the characters that rules this out, and one exact for any text.

    Libraries follow different versions of Unicode, so what is a letter, a number or
    white space is asked of the tokenizer's own one, for every character.  ``re`` has
    no ``\\p``; its classes serve where no character of a text is told differently.
    """
    import regex
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}

    def known(name):
        library = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
        return set(library.decode(library.encode_ordinary(every)))

    letters, numbers, spaces = (known(name) for name in (r"\p{L}", r"\p{N}", r"\s"))
    plain = {r"\p{L}": (r"[^\W\d_]", letters), r"\p{N}": (r"\d", numbers), r"\s": (r"\s", spaces),
             OTHER: (r"(?:[^\s\w]|_)", set(every) - letters - numbers - spaces)}
    fast, odd = pattern, set()
    for name in (OTHER, r"\p{L}", r"\p{N}", r"\s"):
        fast = fast.replace(name, plain[name][0])
        odd |= set(re.findall(plain[name][0], every)) ^ plain[name][1]
    if "\\p" in fast or "\\P" in fast:
        fast = ""
    exact = pattern
    for name, theirs in ((r"\p{L}", letters), (r"\p{N}", numbers)):
        ours = set(regex.findall(name, every))
        if ours != theirs:  # as nested sets, which may also stand within a class
            more, less = _ranges(theirs - ours), _ranges(ours - theirs)
            kept = f"[{name}--[{less}]]" if less else name
            exact = exact.replace(name, f"[{kept}||[{more}]]" if more else kept)
    return fast, _ranges(odd), exact


def ascii_pattern(pattern: str) -> str:
    """The pattern for ASCII texts and Python's ``re``: classes as plain ranges."""
    inner = {"\\p{L}": "A-Za-z", "\\p{N}": "0-9", "\\s": "\\t-\\r "}
    out, at, within = [], 0, False
    while at < len(pattern):
        known = next((k for k in (*inner, "\\S") if pattern.startswith(k, at)), None)
        if known == "\\S" and not within:
            out.append("[^\\t-\\r ]")
        elif known in inner:
            out.append(inner[known] if within else f"[{inner[known]}]")
        else:
            known = pattern[at:at + 2] if pattern[at] == "\\" else pattern[at]
            within = (within or known == "[") and known != "]"
            out.append(known)
        at += len(known)
    return "".join(out)


def _ranges(characters: set[str]) -> str:
    """A set of characters as ranges of a character class."""
    out, codes = [], sorted(map(ord, characters))
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


class ByteBpe:
    """Encodes texts as ids, and ids as bytes.

    ``merges`` are ``last_merges(tokens)``, ``texts`` is ``patterns(pattern)``.
    """

    def __init__(self, tokens: list[bytes], merges: list[tuple[int, int] | None], pattern: str, texts: tuple[str, str, str]):
        import ahocorasick
        import regex

        self.tokens = tokens
        self.rank_of = {t: i for i, t in enumerate(tokens)}
        self.size = [len(t) for t in tokens]
        self.written = [i.to_bytes(4, "little") for i in range(len(tokens))]
        fast, odd, exact = texts
        self.exact_pieces = regex.compile(exact, regex.V1)
        self.fast_pieces = re.compile(fast) if fast else self.exact_pieces
        self.ascii_pieces = re.compile(ascii_pattern(pattern)) if fast else self.exact_pieces
        self.odd = re.compile(f"[{odd}]" if odd else "(?!)")
        self.count = len(tokens)
        self.left = [m[0] if m else -1 for m in merges]
        self.right = [m[1] if m else -1 for m in merges]
        self.merged = {m[0] * self.count + m[1]: t for t, m in enumerate(merges) if m and m[0] >= 0}
        reached = {tokens[t]: t for t, m in enumerate(merges) if m}
        self.shorter = [-1] * self.count
        self.automaton = ahocorasick.Automaton()
        for token, t in reached.items():
            self.shorter[t] = next((reached[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in reached), -1)
            self.automaton.add_word(token.decode("latin-1"), t)
        self.automaton.make_automaton()
        self.fitting: dict[int, bool] = {}
        self.kept: dict[str, bytes] = {}

    def _fits(self, a: int, b: int) -> bool:
        """Whether the merges leave ``b`` behind ``a``.

        Undoes the merges next to their border, the last one first.  They don't stay
        apart if two that were there at the same time make a token before either
        side's next merge: strictly before the left one's, whose pair begins further
        left, and not after the right one's.
        """
        limit = self.count  # merges of this rank or higher come later
        while True:
            if self.merged.get(a * self.count + b, self.count) < limit:
                return False
            a_made = a if self.left[a] >= 0 else -1
            b_made = b if self.left[b] >= 0 else -1
            if a_made < 0 and b_made < 0:
                return True
            if a_made > b_made:
                a, limit = self.right[a], a_made
            else:
                b, limit = self.left[b], b_made + 1

    def backtrack(self, piece: bytes) -> list[int]:
        """The ids that the merges give for one piece."""
        n, size, shorter, count, fitting = len(piece), self.size, self.shorter, self.count, self.fitting
        longest = [0] * n
        for end, t in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - size[t]] = t  # later ends are longer
        left = bytearray(n + 1)
        out: list[int] = []
        at, t = 0, longest[0]
        while True:
            end = at + size[t]
            if not left[end]:
                pair = out[-1] * count + t if out else -1
                if pair < 0:
                    fits = True
                elif (fits := fitting.get(pair)) is None:
                    if len(fitting) >= FITTING_PAIRS:
                        fitting.clear()
                    fits = fitting[pair] = self._fits(out[-1], t)
                if fits:
                    out.append(t)
                    if end == n:
                        return out
                    at, t = end, longest[end]
                    continue
            t = shorter[t]
            while t < 0:
                left[at] = 1
                t = out.pop()
                at -= size[t]
                t = shorter[t]

    def _ids_of(self, piece: str) -> bytes:
        ids = self.kept.get(piece)
        if ids is None:
            data = piece.encode()
            whole = self.rank_of.get(data)
            ids = b"".join(map(self.written.__getitem__, [whole] if whole is not None else self.backtrack(data)))
            if len(piece) <= LONGEST_KEPT:
                if len(self.kept) >= KEPT_PIECES:
                    self.kept.clear()
                self.kept[piece] = ids
        return ids

    def _list(self, pieces: list[str]) -> bytes:
        try:
            return b"".join(map(self.kept.__getitem__, pieces))
        except KeyError:
            return b"".join(map(self._ids_of, pieces))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pattern = (self.ascii_pieces if text.isascii() else
                   self.exact_pieces if self.odd.search(text) else self.fast_pieces)
        if len(text) <= PART_CHARACTERS:
            return self._list(pattern.findall(text))
        out, some = [], []
        for match in pattern.finditer(text):
            some.append(match.group())
            if len(some) == PART_CHARACTERS // 4:
                out.append(self._list(some))
                some = []
        return b"".join([*out, self._list(some)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


def _encode(tables):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        bpe = ByteBpe(*tables.value)
        for batch in batches:
            for a, b in text_chunks(batch.column(1)):
                ids = [bpe.encode(t) if t else b"" for t in batch.column(1).slice(a, b - a).to_pylist()]
                yield batch_of(schema, batch.column(0).slice(a, b - a), [len(x) // 4 for x in ids], ids)
    return run


def _decode(tables):
    def run(batches):
        tokens = tables.value[0]
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            for a, b in text_chunks(ids):
                data = [b"".join(map(tokens.__getitem__, memoryview(x or b"").cast("I"))) for x in
                        ids.slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns), pa.array(data, pa.binary())],
                    names=[*batch.schema.names, "decoded"])
    return run


def _tables(spark, ranks_file: str, pattern: str):
    """A broadcast of the vocabulary and its merges: bounded by the rank file."""
    tokens = read_ranks(ranks_file)
    return spark.sparkContext.broadcast((tokens, last_merges(tokens), pattern, patterns(pattern)))


def encode(documents: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """``documents(doc_id, text)`` -> ``(doc_id, n_tokens, ids)``, the ids as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded separately, one that is a token as it
    stands as that token; no special tokens.  Null and empty texts have no ids;
    null and repeated doc_ids are kept as they are; an empty table gives no rows.
    Other columns are ignored.  The rank file must list the merges in their order
    and every byte (ValueError otherwise).
    """
    tables = _tables(documents.sparkSession, ranks_file, pattern)
    return pick(documents, doc_id="long", text="string").mapInArrow(
        _encode(tables), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_file: str) -> DataFrame:
    """``encoded(doc_id, n_tokens, ids)`` -> the same and ``decoded``, the bytes of the ids.

    Null ids are none; an id beyond the rank file is an error.
    """
    tokens = encoded.sparkSession.sparkContext.broadcast((read_ranks(ranks_file),))
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        _decode(tokens), "doc_id long, n_tokens long, ids binary, decoded binary")
