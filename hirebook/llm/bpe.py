"""BPE encoding and decoding by per-prefix dynamic programming.

For every prefix of a word there is one last token that byte-pair encoding of
that prefix ends with.  An automaton over the vocabulary yields, for each
prefix, the tokens that are its suffixes, longest first.  A token is the last
one if it is the whole prefix, or if it may stand after the last token of the
rest: undoing the merges of the two tokens at their common border, the latest
first, no merge across the border would have come earlier.  The answer is
stored per prefix and the ids follow from the back-pointers.  No merge is ever
replayed over a text, so the work is linear in its length.

The tokenizer file (JSON of the public ``tokenizers`` library: BPE with an
end-of-word suffix, NFC, white space, lower case, byte-level symbols) is a
parameter; its bytes are broadcast, so executors need no copy of the path.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirebook.llm.common import lean

# What the file's splitter and word end say.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
CLASSES = (r"\s", r"\p{L}", r"\p{N}")

CACHE = 100_000  # words of the newer and of the older half of the cache
PAIRS = 200_000  # pairs of tokens, then their cache starts anew


def _ranges(marked: np.ndarray) -> str:
    """Marked code points as the inside of a regular expression's set."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edge.reshape(-1, 2))


ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0d\x20a-z0-9]+").findall


def low_plane(inside: str) -> str:
    """Of a set's ranges, those that begin in the first plane."""
    return "".join(r for r in re.findall(r"\\U.{8}-\\U.{8}", inside) if int(r[2:10], 16) < 0x10000)


def _plain(text: str) -> str:
    """Composed and in lower case, character by character, by Python's tables."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@lru_cache(maxsize=2)
def unicode_tables(data: bytes) -> tuple[str, str, str, str]:
    """White space, letters and numbers as the file's own splitter sees them,
    and the code points that the file's normaliser or splitter treats in
    another way than Python's tables (of another Unicode version) or may
    compose in another way; all as sets of a regular expression.

    Asked once on the driver, of every code point, and broadcast.
    """
    from tokenizers import Regex, pre_tokenizers

    marked, mine = np.zeros((2, len(CLASSES), 0x110000), bool)
    odd, whole = np.zeros(0x110000, bool), normaliser(data)
    outside = [pre_tokenizers.Split(Regex(f"[{c}]+"), "removed") for c in CLASSES]
    for at in range(0, 0x110000, 4096):
        cps = [c for c in range(at, at + 4096) if not 0xD800 <= c < 0xE000]
        if not cps:
            continue
        text = "".join(map(chr, cps))
        for k, c in enumerate(CLASSES):
            marked[k, cps] = True
            for _, (i, j) in outside[k].pre_tokenize_str(text):
                marked[k, cps[i:j]] = False
            mine[k, [ord(x) for x in regex.findall(c, text)]] = True
        for cp, x in zip(cps, text):
            odd[cp] = unicodedata.category(x) == "Cn" or whole(x) != (" " if marked[0, cp] else _plain(x))
    odd |= (mine != marked).any(axis=0)
    return *map(_ranges, marked), _ranges(odd)


def _splitter(space: str, letters: str, numbers: str):
    return re.compile(SPLIT.replace(r"\s", space).replace(r"\p{L}", letters).replace(r"\p{N}", numbers)).findall


def normaliser(data: bytes):
    """The file's own normaliser, as a function of a text."""
    from tokenizers import Regex, normalizers

    steps = []
    for n in json.loads(data)["normalizer"]["normalizers"]:
        if n["type"] == "Replace":
            steps.append(normalizers.Replace(Regex(n["pattern"]["Regex"]), n["content"]))
        else:
            steps.append(getattr(normalizers, n["type"])())
    return normalizers.Sequence(steps).normalize_str


def byte_symbols() -> dict[str, int]:
    """Printable stand-in of each byte, as byte-level BPE files write them."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """One vocabulary.  Inside, tokens are numbered base symbols first, then
    by the order of merges; a word is a string of one character a symbol
    (0-255 a byte, 256-511 a byte that ends the word)."""

    def __init__(self, data: bytes, tables: tuple | None = None):
        spec = json.loads(data)
        model, vocab = spec["model"], spec["model"]["vocab"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END or model.get("byte_fallback") or model.get("dropout"):
            raise ValueError("the tokenizer file must be BPE with word ends, without dropout or byte fallback")
        if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != SPLIT:
            raise ValueError("the tokenizer file splits words by another pattern")
        if [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("the tokenizer file normalises in another way")
        space, letters, numbers, odd = tables or unicode_tables(data)
        # texts of characters that all tables agree on take the short way; anything beyond the first plane is looked at twice
        self.may_be_odd = re.compile(f"[{low_plane(odd)}\U00010000-\U0010ffff]")
        self.odd = re.compile(f"[{odd}]") if odd else re.compile("(?!)")
        self.normal = normaliser(data)
        classes = space, letters, numbers
        self.words_of = _splitter(*classes)
        self.low_words_of = _splitter(*map(low_plane, classes))  # a set of the first plane alone is a table look-up
        symbols = byte_symbols()
        keys, names, inner = [], [], {}

        def add(name: str, key: str) -> int:
            inner[name] = len(keys)
            keys.append(key)
            names.append(name)
            return len(keys) - 1

        for c, b in symbols.items():
            add(c, chr(b))
            add(c + WORD_END, chr(256 + b))
        self.base = len(keys)
        self.left, self.right, self.joined = list(range(self.base)), list(range(self.base)), {}
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if a + b in inner:
                raise ValueError(f"two merges make {a + b!r}")
            i, j = inner[a], inner[b]
            self.joined[i, j] = add(a + b, keys[i] + keys[j])
            self.left.append(i)
            self.right.append(j)
        self.length = [len(k) for k in keys]
        self.id_of = [vocab[n] for n in names]
        self.bytes_of = [int(i).to_bytes(4, "little") for i in self.id_of]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.may, self.new, self.old = {}, {}, {}
        self.automaton = ahocorasick.Automaton()
        whole = [True] * self.base
        for t in range(self.base, len(keys)):
            i, j = self.left[t], self.right[t]
            whole.append(whole[i] and whole[j] and self._compatible(i, j, t))
        for t, key in enumerate(keys):
            if whole[t]:  # a token that its own text isn't encoded as never is a last token
                self.automaton.add_word(key, t)
        self.automaton.make_automaton()

    def _compatible(self, a: int, b: int, bound: int = 1 << 60) -> bool:
        """Whether encoding the two tokens' joint text leaves them as they are."""
        while True:
            if self.joined.get((a, b), bound) < bound:
                return False
            if a < self.base and b < self.base:
                return True
            if a > b:
                bound, a = a, self.right[a]
            else:  # of equal merges the left one comes first
                bound, b = b + 1, self.left[b]

    def _word(self, word: str) -> bytes:
        raw = word.encode("utf-8", "replace")
        key = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        length, may = self.length, self.may
        last = [-1] * (len(key) + 1)
        for end, token in self.automaton.iter(key):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length[token]
            if start:
                pair = last[start] << 20 | token
                ok = may.get(pair)
                if ok is None:
                    if len(may) >= PAIRS:
                        may.clear()
                    ok = may[pair] = self._compatible(last[start], token)
                if not ok:
                    continue
            last[end] = token
        out, end = [], len(key)
        while end:
            out.append(self.bytes_of[last[end]])
            end -= length[last[end]]
        out.reverse()
        return b"".join(out)

    def _split(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        if text.isascii():
            return ASCII_WORDS(text.lower())
        if not self.may_be_odd.search(text):
            return self.low_words_of(_plain(text))
        if not self.odd.search(text):
            return self.words_of(_plain(text))
        return self.words_of(self.normal(text))

    def _piece(self, text: str) -> bytes:
        new, old, out = self.new, self.old, []
        for w in self._split(text):
            ids = new.get(w)
            if ids is None:
                ids = old.get(w) or self._word(w)
                if len(w) <= 64:
                    if len(new) >= CACHE:
                        self.old, old = new, new
                        self.new = new = {}
                    new[w] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        text = text or ""
        if not self.cut or not self.cut.search(text):
            return self._piece(text)
        return b"".join(int(self.special[p]).to_bytes(4, "little") if p in self.special else self._piece(p)
                        for p in self.cut.split(text) if p)

    def decode(self, ids: bytes) -> str:
        """The tokens' strings, joined by spaces; special tokens included."""
        return " ".join(map(self.text_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[str, Encoder] = {}


def encoder(data: bytes, tables: tuple | None = None) -> Encoder:
    """The process's encoder of a tokenizer file."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(data, tables)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text", carry: tuple = ("doc_id",),
                     rows: int = 256) -> DataFrame:
    """The ``carry`` columns of every row with n_tokens, ids and decoded.

    ids: binary, little-endian unsigned 32-bit; decoded: the text that the
    ids decode to.  Null and empty texts have no ids and decode to "".  Texts
    of any length are encoded whole, ``rows`` at a time.  Other columns are
    not read; an empty table gives an empty result.
    """
    with open(tokenizer_path, "rb") as f:
        data = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((data, unicode_tables(data)))
    src = docs.select(*(F.col(f"`{c}`") for c in carry), F.col(text_col).alias("_text"))
    schema = src.drop("_text").withColumns({"n_tokens": F.lit(0).cast("long"), "ids": F.lit(b""), "decoded": F.lit("")}).schema
    names = schema.fieldNames()

    def run(batches):
        coder = encoder(*shared.value)
        for b in batches:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                ids = [coder.encode(t) for t in part.column(len(carry)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(carry))), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()), pa.array([coder.decode(x) for x in ids], pa.string())], names)

    return src.mapInArrow(lean(run), schema)


def digests(encoded: DataFrame) -> DataFrame:
    """ids and decoded of ``encode_documents`` as SHA-256 (lowercase hex)."""
    keep = [F.col(f"`{c}`") for c in encoded.columns if c not in ("ids", "decoded")]
    return encoded.select(*keep, F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))
