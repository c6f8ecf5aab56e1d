"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Each pre-token has a complete binary tree over its adjacent pairs; a leaf holds the
pair's rank and place, an inner node the smaller of its children. The root is the
leftmost lowest-rank merge; a merge changes three leaves and their paths. Distinct
pre-tokens of like length are worked on together, their trees as rows of one array.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from tokenizers import normalizers

from chronostar.llm.common import map_texts

NO_PAIR = np.iinfo(np.int64).max
#: Pairs up to which trees are rows of one array; longer pre-tokens have one of their own.
SHARED_TREE = 64
#: Pre-tokens that a task remembers between slices.
REMEMBERED = 200_000
_PLACE = 32

# Letters and digits of Unicode 16, first and last of each run, that Unicode 15.1 does not have.
NEWER = {
    r"\p{L}": [
        (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
        (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
        (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
        (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
    ],
    r"\p{N}": [
        (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
        (0x1E5F1, 0x1E5FA),
    ],
    r"\s": [],
}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    of = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [of[b] for b in range(256)]


@dataclass
class WordVocabulary:
    """A byte-level vocabulary with word ends, lower case, white space dropped."""

    tokens: list[str]
    inner: np.ndarray  # id of each byte
    last: np.ndarray  # id of each byte at a word's end
    keys: np.ndarray  # sorted left * size + right
    ranks: np.ndarray
    made: np.ndarray
    pattern: re.Pattern
    latin: re.Pattern  # the same for texts of Latin-1 characters only, which it reads faster
    special: dict[str, int]

    @staticmethod
    def read(path: str) -> WordVocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, kinds = spec["model"], [x["type"] for x in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        plain = not any(x[k] for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or level["use_regex"] or not plain or spec["decoder"]:
            raise ValueError("another kind of vocabulary")
        ids, end = model["vocab"], model["end_of_word_suffix"]
        tokens = [""] * (max([*ids.values(), *(x["id"] for x in spec["added_tokens"])]) + 1)
        for t, i in ids.items():
            tokens[i] = t
        for x in spec["added_tokens"]:
            tokens[x["id"]] = x["content"]
        pairs = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            pairs[ids[a] * len(tokens) + ids[b]] = (rank, ids[a + b])
        keys = np.array(sorted(pairs), np.int64)
        shown = byte_characters()
        return WordVocabulary(
            tokens,
            np.array([ids[c] for c in shown], np.int64),
            np.array([ids[c + end] for c in shown], np.int64),
            keys,
            np.array([pairs[k][0] for k in keys.tolist()], np.int64),
            np.array([pairs[k][1] for k in keys.tolist()], np.int64),
            pattern_of(split["pattern"]["Regex"]),
            pattern_of(split["pattern"]["Regex"], 0x100),
            {x["content"]: x["id"] for x in spec["added_tokens"]},
        )

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * len(self.tokens) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], NO_PAIR >> _PLACE), self.made[at]


@cache
def character_classes(below: int) -> dict[str, str]:
    """Letters, numbers and white space as sets for the standard library's patterns: those of Python's
    Unicode version and of the newer one that the vocabularies' library reads patterns by."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(below)]
    space = {*range(9, 14), 0x20, 0x85, *(c for c, k in enumerate(kinds) if k == "Z")}
    out = {}
    for name, own in (
        (r"\p{L}", [k == "L" for k in kinds]),
        (r"\p{N}", [k == "N" for k in kinds]),
        (r"\s", [c in space for c in range(below)]),
    ):
        for a, b in NEWER[name]:
            own[a : b + 1] = [True] * len(own[a : b + 1])
        out[name] = _ranges(own)
    return out


def _ranges(own: list[bool]) -> str:
    """The code points marked, as ranges of a pattern's set."""
    edges = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2).tolist())


@cache
def _unsettled() -> re.Pattern:
    """Code points on whose normal form or case tables of two versions may differ: those that Python's
    Unicode version does not know, and marks and composed characters later than Unicode 3.2."""
    first = unicodedata.ucd_3_2_0

    def late(c: str) -> bool:
        kind = unicodedata.category(c)
        return kind == "Cn" or first.category(c) == "Cn" and (kind[0] == "M" or unicodedata.decomposition(c) != "")

    return re.compile(f"[{_ranges([late(chr(c)) for c in range(0x110000)])}]")


def pattern_of(text: str, below: int = 0x110000) -> re.Pattern:
    """A vocabulary's pattern for texts of code points under a bound, its classes written out."""
    for name, chars in character_classes(below).items():
        text = text.replace(name, chars)
    return re.compile(text)


def _leaf(rank: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.where(rank < NO_PAIR >> _PLACE, (rank << _PLACE) | place, NO_PAIR)


def merge_alike(model: WordVocabulary, symbols: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """Token ids (as 32-bit integers) of pre-tokens given as rows (padded), one tree a row."""
    rows, width = symbols.shape
    leaves = 1
    while leaves < width - 1:
        leaves *= 2
    place = np.arange(width)
    rank, made = model.look_up(symbols[:, :-1], symbols[:, 1:])
    rank = np.where(place[:-1] < lengths[:, None] - 1, rank, NO_PAIR >> _PLACE)
    result = np.zeros((rows, width), np.int64)
    result[:, :-1] = made
    tree = np.full((rows, 2 * leaves), NO_PAIR)
    tree[:, leaves : leaves + width - 1] = _leaf(rank, place[:-1])
    level = leaves // 2
    while level:
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        level //= 2
    # The neighbours of each place; place `width` stands for none.
    after = np.where(place + 1 < lengths[:, None], place + 1, width)
    before = np.broadcast_to(np.where(place > 0, place - 1, width), (rows, width)).copy()
    alive = place < lengths[:, None]
    live = np.flatnonzero(tree[:, 1] != NO_PAIR)
    while len(live):
        left = tree[live, 1] & ((1 << _PLACE) - 1)
        right = after[live, left]
        follow = after[live, right]
        symbols[live, left] = result[live, left]
        alive[live, right] = False
        after[live, left] = follow
        has = follow < width
        before[live[has], follow[has]] = left[has]
        tree[live, leaves + np.minimum(right, leaves - 1)] = np.where(
            right < leaves, NO_PAIR, tree[live, leaves + np.minimum(right, leaves - 1)]
        )
        prior = before[live, left]
        own = prior < width
        r = np.r_[live[has], live[own]]
        a, b = np.r_[left[has], prior[own]], np.r_[follow[has], left[own]]
        rank, result[r, a] = model.look_up(symbols[r, a], symbols[r, b])
        tree[live[~has], leaves + left[~has]] = NO_PAIR
        tree[r, leaves + a] = _leaf(rank, a)
        r = np.r_[live, live, live[own]]
        node = (np.r_[left, np.minimum(right, leaves - 1), prior[own]] + leaves) >> 1
        while len(node) and node[0]:
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
            node >>= 1
        live = live[tree[live, 1] != NO_PAIR]
    ids, ends = symbols[alive].astype("<u4").tobytes(), (4 * np.cumsum(alive.sum(1))).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


def merge_long(model: WordVocabulary, symbols: np.ndarray) -> bytes:
    """Token ids (as 32-bit integers) of one long pre-token; its tree is a list."""
    n = len(symbols)
    leaves = 1
    while leaves < n:
        leaves *= 2
    rank, made = model.look_up(symbols[:-1], symbols[1:])
    tree = np.full(2 * leaves, NO_PAIR)
    tree[leaves : leaves + n - 1] = _leaf(rank, np.arange(n - 1))
    level = leaves // 2
    while level:
        tree[level : 2 * level] = np.minimum(tree[2 * level : 4 * level : 2], tree[2 * level + 1 : 4 * level : 2])
        level //= 2
    tree, result, out = tree.tolist(), [*made.tolist(), 0], symbols.tolist()
    pairs = _pair_table(model)
    size, none, low = len(model.tokens), NO_PAIR, (1 << _PLACE) - 1
    after, before = [*range(1, n), -1], list(range(-1, n - 1))

    def put(place: int, value: int) -> None:
        node = place + leaves
        tree[node] = value
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            value = a if a < b else b
            if tree[node] == value:
                break
            tree[node] = value
            node >>= 1

    def renew(a: int, b: int) -> None:
        found = pairs.get(out[a] * size + out[b]) if b >= 0 else None
        if found:
            result[a] = found[1]
        put(a, found[0] << _PLACE | a if found else none)

    while tree[1] != none:
        left = tree[1] & low
        right = after[left]
        out[left], follow = result[left], after[right]
        out[right], after[left] = -1, follow
        if follow >= 0:
            before[follow] = left
        put(right, none)
        renew(left, follow)
        if before[left] >= 0:
            renew(before[left], left)
    return np.array([x for x in out if x >= 0], "<u4").tobytes()


_tables: dict[int, dict] = {}


def _pair_table(model: WordVocabulary) -> dict[int, tuple[int, int]]:
    if id(model) not in _tables:
        _tables[id(model)] = dict(zip(model.keys.tolist(), zip(model.ranks.tolist(), model.made.tolist())))
    return _tables[id(model)]


def encode_pretokens(model: WordVocabulary, pretokens: list[str]) -> list[bytes]:
    """Token ids of each (non-empty) pre-token, as little-endian 32-bit integers."""
    data = [p.encode() for p in pretokens]
    lengths = np.array([len(d) for d in data], np.int64)
    out: list = [None] * len(data)
    kinds = np.ceil(np.log2(np.maximum(lengths - 1, 1))).astype(int)
    for kind in np.unique(kinds):
        at = np.flatnonzero(kinds == kind)
        if 1 << kind > SHARED_TREE:
            for i in at:
                bytes_ = np.frombuffer(data[i], np.uint8)
                out[i] = merge_long(model, np.r_[model.inner[bytes_[:-1]], model.last[bytes_[-1:]]])
            continue
        width = max(2, (1 << kind) + 1)
        rows = np.zeros((len(at), width), np.int64)
        flat = np.frombuffer(b"".join(data[i] for i in at), np.uint8)
        own = lengths[at]
        row = np.repeat(np.arange(len(at)), own)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(own) - own, own)
        rows[row, col] = model.inner[flat]
        rows[np.arange(len(at)), own - 1] = model.last[flat[np.cumsum(own) - 1]]
        for i, ids in zip(at, merge_alike(model, rows, own)):
            out[i] = ids
    return out


@cache
def _vocabulary(path: str) -> WordVocabulary:
    return WordVocabulary.read(path)


def lower(text: str) -> str:
    """Lower case character by character, without the rule for a final sigma."""
    return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)


_LIKE_VOCABULARIES = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])


def normal(text: str) -> str:
    """NFC and lower case. A text with a character that tables of different versions may treat differently
    is given to the tables of the vocabularies' library."""
    if not _is_latin(text) and _unsettled().search(text):
        return _LIKE_VOCABULARIES.normalize_str(text)
    return lower(unicodedata.normalize("NFC", text))


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Encodes and decodes whole texts; remembers pre-tokens between slices."""

    def __init__(self, path: str):
        self.model = _vocabulary(path)
        self.known: dict[str, bytes] = {}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.model.special)) + ")")

    def pretokens(self, text: str) -> list[str]:
        """Pre-tokens; the added tokens' own strings stay whole."""
        out: list[str] = []
        for part in self.marks.split(text) if "<|" in text else [text]:
            if part in self.model.special:
                out.append(part)
            elif part:
                part = normal(part)
                out += (self.model.latin if _is_latin(part) else self.model.pattern).findall(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, special = self.known, self.model.special
        cut = [self.pretokens(t) for t in texts]
        new = list({p for ps in cut for p in ps if p not in known})
        known.update((p, np.array([special[p]], "<u4").tobytes()) for p in new if p in special)
        new = [p for p in new if p not in special]
        known.update(zip(new, encode_pretokens(self.model, new)))
        return [b"".join(map(known.__getitem__, ps)) for ps in cut]

    def decode(self, ids: bytes) -> str:
        """Tokens with a space between them: the vocabulary names no decoder."""
        return " ".join(map(self.model.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", digests: bool = False
) -> DataFrame:
    """key, n_tokens and either ids (array of int) and decoded text, or their SHA-256.

    Null texts are empty: no ids, an empty decoded text. Repeated rows and null keys give
    rows of their own; an empty table gives none. Only the two columns named are read.
    """

    def work():
        encoder = Encoder(vocabulary)

        def step(keys, texts):
            ids = encoder.encode(texts)
            out = {"key": keys, "n_tokens": [len(x) // 4 for x in ids]}
            if digests:
                return out | {
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(encoder.decode(x).encode()).hexdigest() for x in ids],
                }
            return out | {"ids": [np.frombuffer(x, "<u4").astype("i4") for x in ids], "decoded": list(map(encoder.decode, ids))}

        return step

    kind = docs.schema[key].dataType.simpleString()
    more = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    out = map_texts(docs, key, text, work, f"key {kind}, n_tokens long, {more}")
    return out.withColumnRenamed("key", key) if key != "key" else out
