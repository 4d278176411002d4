"""BPE encoding and decoding by prefix-sharing trie traversal.

Encodes as a given word-end BPE tokenizer file does. The distinct words of an
Arrow batch that are not known yet are inserted into a trie of byte symbols, in
depth-first order. Each node gets the last token of its prefix's encoding: the
one token that ends there and may follow the last token of what stands before
it. States are passed down the trie, so a prefix shared by many words is
encoded once; a word's tokens are read back from its end.

Memory is bounded: trie and known words are forgotten when they grow too large,
and words of over ``TRIE_SYMBOLS`` symbols walk the same states alone instead
of being stored. None of this changes a result.

Defined results: null and empty texts have no ids and decode to ""; ids that
the vocabulary lacks are skipped by ``decode``; null ids lists decode to "";
repeated rows get equal results; an empty table gives an empty result; other
columns pass through, but one named like a result is replaced; long texts are
split at spaces and line ends, which no word spans.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_arrow_batches, text_of

TRIE_SYMBOLS, TRIE_NODES = 64, 150_000
TOKEN, START = 0, 1
#: Words and token pairs whose results a worker remembers; with the trie about 140 MB.
KNOWN_WORDS, KNOWN_PAIRS = 400_000, 150_000
#: Characters normalised and split at a time.
PIECE = 1 << 16
_NEVER = 1 << 60


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """A tokenizer file with word-end BPE, made ready for trie traversal."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: s for s, i in {**self.ids, **self.special}.items()}
        self.split_special = regex.compile("|".join(
            regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.words = regex.compile(next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.symbols = dict(enumerate(byte_symbols()))
        # The longest token for each last three symbols, within a word and at its end; others have two at most.
        self.reach: tuple[dict[str, int], dict[str, int]] = ({}, {})
        for token in self.ids:
            at_end = bool(self.end) and token.endswith(self.end)
            body = token[:-len(self.end)] if at_end else token
            place = self.reach[at_end]
            place[body[-3:]] = max(place.get(body[-3:], 2), len(body))
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            pair, whole = (self.ids[a], self.ids[b]), self.ids[a + b]
            self.rank[pair] = rank
            self.parts.setdefault(whole, pair)
            self.made.setdefault(whole, rank)
        self.follows: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        # A node holds its prefix's last token, where that starts, and its children by symbol.
        self.trie: dict = {}
        self.nodes = 0

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, rank of the merge that uses it up) along one side of a token, smallest part first."""
        out, gone = [], _NEVER
        while True:
            out.append((token, gone))
            if token not in self.parts:
                return out[::-1]
            gone, token = self.made[token], self.parts[token][side]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging left's and right's symbols together ends with just these two tokens.

        It does not if some merge across the border comes before the merges
        that use up the parts it joins; of equal ranks the left one comes first.
        """
        a, b = self.edge(left, 1), self.edge(right, 0)
        i = j = 0
        good = True
        while good:
            (x, x_gone), (y, y_gone) = a[i], b[j]
            across = self.rank.get((x, y), _NEVER)
            good = across == _NEVER or across >= x_gone or across > y_gone
            if x_gone == y_gone == _NEVER:
                break
            if x_gone <= y_gone:
                i += 1
            else:
                j += 1
        if len(self.follows) > KNOWN_PAIRS:
            self.follows.clear()
        self.follows[left, right] = good
        return good

    def last_token(self, text: str, at: int, last: list[int], end: str = "") -> tuple[int, int]:
        """The last token (and where it starts) of the encoding of text[:at], given those of all shorter prefixes."""
        ids, known = self.ids, self.follows
        for start in range(max(0, at - self.reach[bool(end)].get(text[max(0, at - 3):at], 2)), at):
            token = ids.get(text[start:at] + end)
            if token is not None:
                if start == 0:
                    return token, start
                good = known.get((last[start], token))
                if good or good is None and self.may_follow(last[start], token):
                    return token, start
        raise ValueError(f"no token ends at {at} in {text!r}")

    def read_back(self, text: str, last: list[int], begins: list[int]) -> bytes:
        token, at = self.last_token(text, len(text), last, self.end)
        out = [token]
        while at:
            out.append(last[at])
            at = begins[at]
        return np.array(out[::-1], np.int32).tobytes()

    def encode_words(self, words: set[str]) -> dict[str, bytes]:
        """The ids of each word, as the bytes of 32-bit numbers."""
        out: dict[str, bytes] = {}
        last, begins = [0] * TRIE_SYMBOLS, [0] * TRIE_SYMBOLS
        for word in sorted(words):  # the trie's depth-first order
            text = word.encode().decode("latin-1").translate(self.symbols)
            if len(text) > TRIE_SYMBOLS:
                out[word] = self.encode_alone(text)
                continue
            if self.nodes > TRIE_NODES:
                self.trie, self.nodes = {}, 0
            node = self.trie
            for at in range(1, len(text)):
                child = node.get(text[at - 1])
                if child is None:
                    token, start = self.last_token(text, at, last)
                    child = node[text[at - 1]] = {TOKEN: token, START: start}
                    self.nodes += 1
                last[at], begins[at] = child[TOKEN], child[START]
                node = child
            out[word] = self.read_back(text, last, begins)
        return out

    def encode_alone(self, text: str) -> bytes:
        last, begins = [0], [0]
        for at in range(1, len(text)):
            token, start = self.last_token(text, at, last)
            last.append(token)
            begins.append(start)
        return self.read_back(text, last, begins)

    def normalise(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # Lower-casing is by character: capital sigma has no other form at a word's end.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, text: str) -> Iterator[str]:
        """Cuts a long text at spaces or line ends; words and composed characters never span these."""
        at = 0
        while len(text) - at > PIECE:
            cut = max(text.rfind(" ", at, at + PIECE), text.rfind("\n", at, at + PIECE))
            if cut < 0:
                ends = [e for e in (text.find(" ", at + PIECE), text.find("\n", at + PIECE)) if e >= 0]
                if not ends:
                    break
                cut = min(ends)
            yield text[at:cut + 1]
            at = cut + 1
        yield text[at:]

    def split(self, text: str) -> list[str | int]:
        """Words in order; special tokens as their ids."""
        out: list[str | int] = []
        at = 0
        for hit in [*self.split_special.finditer(text), None]:
            for piece in self.pieces(text[at:hit.start() if hit else len(text)] if hit or at else text):
                out += self.words.findall(self.normalise(piece))
            if hit:
                out.append(self.special[hit.group()])
                at = hit.end()
        return out

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.split(t) for t in texts]
        words = set().union(*split)
        new = words.difference(self.known)
        if new:
            if len(self.known) + len(new) > KNOWN_WORDS:  # only the batch's own words stay, among them the frequent ones
                self.known = {w: self.known[w] for w in words.intersection(self.known)}
            self.known |= self.encode_words({w for w in new if isinstance(w, str)})
            self.known |= {w: np.array([w], np.int32).tobytes() for w in new if isinstance(w, int)}
        ids = self.known.__getitem__
        return [np.frombuffer(b"".join(map(ids, words)), np.int32) for words in split]

    def decode(self, ids: list[int]) -> str:
        try:
            return " ".join(map(self.names.__getitem__, ids))
        except KeyError:
            return " ".join(self.names[i] for i in ids if i in self.names)


@lru_cache(maxsize=2)
def vocabulary(source: str) -> Vocabulary:
    """One per Python worker, kept from task to task."""
    return Vocabulary(source)


def _sent(df: DataFrame, path: str):
    """The tokenizer file, read by the driver and sent to the executors once (a few MB, whatever the input)."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, text_col: str = "text", to: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text in ``to``."""
    source = _sent(docs, path)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series(vocabulary(source.value).encode_batch(texts.tolist()), dtype=object)

    small_arrow_batches(docs.sparkSession)
    return docs.withColumn(to, ids(text_of(text_col)))


def decode(df: DataFrame, path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for in ``to``."""
    source = _sent(df, path)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        v = vocabulary(source.value)
        return pd.Series([v.decode(i.tolist()) for i in ids], dtype=object)

    small_arrow_batches(df.sparkSession)
    return df.withColumn(to, text(F.coalesce(F.col(ids_col), F.array().cast("array<int>"))))


def round_trip(docs: DataFrame, path: str, text_col: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the ids of each whole text and the text decoded from them, in one pass through Python."""
    source = _sent(docs, path)

    @F.pandas_udf("ids array<int>, decoded string")
    def both(texts: pd.Series) -> pd.DataFrame:
        v = vocabulary(source.value)
        found = v.encode_batch(texts.tolist())
        return pd.DataFrame({"ids": pd.Series(found, dtype=object), "decoded": [v.decode(i.tolist()) for i in found]})

    small_arrow_batches(docs.sparkSession)
    both_col = fresh(docs, "__both")
    out = docs.withColumn(both_col, both(text_of(text_col)))
    return out.withColumns({ids: F.col(f"{both_col}.ids"), decoded: F.col(f"{both_col}.decoded")}).drop(both_col)


def id_text(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), " ")
