"""Byte-pair encoding and decoding of whole texts by a trie of distinct words.

The encoding of a word is fixed by the last token of each of its prefixes: the last token ``t`` of a
prefix is the one whose neighbour on the left, the last token ``u`` of the prefix before ``t``, stays
beside it (encoding ``u`` and ``t`` together gives ``u, t``). The distinct new words of a batch are put
into a trie; one depth-first walk hands the last-token states down, so what words share at their
beginning is encoded once. The final letter is a symbol of its own (it carries the word end) and is
added to the state of the prefix before it.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm.common import kept
from tickloom.llm.textblocks import pieces

#: Words a worker remembers; when there are more, it keeps those that have come up among the last so many.
CACHE_WORDS = 125_000
#: Bytes of text whose words share a trie.
SLICE_BYTES = 1 << 20


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabularies of byte-level tokenizers."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Trie:
    """Distinct words as nodes ``{symbol: node}``; under the key None a node has the words that end after one more letter."""

    def __init__(self, words: Iterable[str]):
        self.root: dict = {}
        for word in words:
            node = self.root
            for symbol in word[:-1]:
                node = node.setdefault(symbol, {})
            node.setdefault(None, []).append(word)


class Bpe:
    """Vocabulary and merges of a tokenizer file, with the last-token walk over words of byte letters."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {p: r for r, p in enumerate(pairs)}
        self.letters = _byte_letters()
        #: tokens that the merges really make of their letters; no other can be a last token
        self.whole = {t for t in self.ids if self.merged(self.symbols(t)) == [t]}
        self.starts = {t[:i] for t in self.ids for i in range(len(t) + 1)}
        self._steps: dict[str, dict[str, tuple]] = {}
        self._n_steps = 0
        self._beside: dict[int, bool] = {}

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and token != self.end:
            letters = list(token[: -len(self.end)])
            letters[-1] += self.end
            return letters
        return list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain merging, lowest rank first and leftmost among equals: for single tokens and pairs."""
        parts = list(symbols)
        while len(parts) > 1:
            rank, at = min((self.ranks.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def step(self, state: str, symbol: str) -> tuple[str, tuple[tuple[int, int], ...]]:
        """The next state (the longest end of the prefix that starts a token), and the tokens that end there.

        Tokens come as (id, letters), longest first. States and steps are those of the vocabulary.
        """
        end = state + symbol
        while end not in self.starts:
            end = end[1:]
        room = len(self.end) if symbol != symbol[0] else 0
        found = tuple((self.ids[end[i:]], len(end) - i - room) for i in range(len(end) - room) if end[i:] in self.whole)
        if not found:
            raise ValueError(f"no token ends in {symbol!r}")
        if self._n_steps >= 6 * CACHE_WORDS:
            self._steps.clear()
            self._n_steps = 0
        self._n_steps += 1
        out = self._steps.setdefault(state, {})[symbol] = (end, found)
        return out

    def beside(self, left: int, right: int) -> bool:
        """Whether the two tokens stay when they are encoded together."""
        if len(self._beside) >= 6 * CACHE_WORDS:
            self._beside.clear()
        pair = [self.tokens[left], self.tokens[right]]
        known = self._beside[left << 32 | right] = self.merged(self.symbols(pair[0]) + self.symbols(pair[1])) == pair
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of every word (byte letters, not empty), by one depth-first walk over their trie."""
        out: dict[str, list[int]] = {}
        last, begins = [], []  # of the prefix with so many letters: its last token, and where that starts
        steps, beside, mark = self._steps, self._beside, self.end

        def reach(state: str, key: str, depth: int) -> tuple[str, int, int]:
            """The state after one more letter, and the last token with its start."""
            known = steps.get(state)
            end, found = known and known.get(key) or self.step(state, key)
            for token, letters in found:
                start = depth + 1 - letters
                if start == 0:
                    return end, token, 0
                left = last[start]
                pair = beside.get(left << 32 | token)
                if pair or pair is None and self.beside(left, token):
                    return end, token, start
            raise ValueError(f"no token ends in {key!r}")

        todo: list[tuple] = [(Trie(words).root, "", 0, 0, 0)]
        while todo:
            node, state, depth, token, start = todo.pop()
            del last[depth:], begins[depth:]
            while node is not None:  # down to a leaf; the other branches wait
                last.append(token)
                begins.append(start)
                follow = None
                for symbol, child in node.items():
                    if symbol is None:
                        for word in child:
                            _, final, at = reach(state, word[-1] + mark, depth)
                            ids = [final]
                            while at:
                                ids.append(last[at])
                                at = begins[at]
                            ids.reverse()
                            out[word] = ids
                        continue
                    if follow is not None:
                        todo.append(follow)
                    end, token, start = reach(state, symbol, depth)
                    follow = (child, end, depth + 1, token, start)
                node, state, depth, token, start = follow or (None, state, depth, token, start)
        return out


class Codec:
    """Encodes and decodes texts; remembers a bounded number of words."""

    def __init__(self, content: str):
        self.bpe = Bpe(content)
        spec = json.loads(content)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.plain = re.compile(
            pattern.replace(r"[\p{L}]", "[a-zA-Z]").replace(r"[\p{N}]", "[0-9]").replace(r"\s\p{L}\p{N}", "\t-\r a-zA-Z0-9")
        ).findall
        self._content, self._library = content, None
        special = sorted(self.bpe.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.numbers = {i: str(i) for i in self.bpe.tokens}
        #: per word its ids and its tokens as UTF-8, one blank between
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self._before: dict[str, tuple[bytes, bytes]] = {}

    @property
    def library(self) -> Tokenizer:
        """Made when a text first needs it, which few do."""
        if self._library is None:
            self._library = Tokenizer.from_str(self._content)
        return self._library

    def pieces(self, text: str | None) -> list[str]:
        """The words of a text in order, its special tokens among them; a null text has none."""
        if not text:
            return []
        if self.specials is None or not self.specials.search(text):
            return self._plain_pieces(text)
        out: list[str] = []
        for part in self.specials.split(text):
            out += [part] if part in self.bpe.special else self._plain_pieces(part)
        return out

    def _plain_pieces(self, text: str) -> list[str]:
        """Composed, in lower case, blanks dropped."""
        if text.isascii():
            return self.plain(text.lower())
        if any(unicodedata.category(c) == "Cn" for c in set(text)):
            # letters newer than Python's tables: the library knows their classes and cases
            text = self.library.normalizer.normalize_str(text)
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # letter by letter: the small sigma has one form wherever it stands
        return self.split(text.replace("Σ", "σ").lower())

    def learn(self, words: set[str]) -> None:
        """Encodes the words that are new, by one walk over their trie.

        When there are too many, those that have not come up since the last time are forgotten.
        """
        known, before = self.known, self._before
        if len(known) + len(words) > CACHE_WORDS:
            self._before, self.known = known, {}
            known, before = self.known, self._before
        new = []
        for word in words:
            if word not in known:
                if word in before:
                    known[word] = before[word]
                else:
                    new.append(word)
        letters, tokens, numbers = self.bpe.letters, self.bpe.tokens, self.numbers
        spelled = {}
        for word in new:
            if word in self.bpe.special:
                known[word] = (str(self.bpe.special[word]).encode(), word.encode())
            else:
                spelled["".join(map(letters.__getitem__, word.encode("utf-8")))] = word
        for spelling, ids in self.bpe.encode_words(spelled).items():
            known[spelled[spelling]] = (" ".join([numbers[i] for i in ids]).encode(), " ".join([tokens[i] for i in ids]).encode())

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; a null or empty text has none."""
        words = self.pieces(text)
        self.learn(set(words))
        return self.ids(words)

    def ids(self, words: list[str]) -> list[int]:
        """Ids of words that have been learned."""
        return [int(i) for w in words for i in self.known[w][0].split()]

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: tokens as they are, one blank between."""
        return " ".join(map(self.bpe.tokens.__getitem__, ids))


def encoded(docs: DataFrame, tokenizer_path: str, content: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` for every row of ``docs``: the ids of its text and what they decode to.

    A null or empty text has no ids and decodes to the empty text. Null and repeated doc_ids stay as
    they are; other columns are not read. The tokenizer file is read on the driver and travels with the
    tasks, as it is one file of fixed size.
    """
    return _mapped(docs, tokenizer_path, content, digests=False)


def digests(docs: DataFrame, tokenizer_path: str, content: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: as :func:`encoded`, with SHA-256 of both results."""
    return _mapped(docs, tokenizer_path, content, digests=True)


def _mapped(docs: DataFrame, tokenizer_path: str, content: str | None, digests: bool) -> DataFrame:
    if content is None:
        with open(tokenizer_path, encoding="utf-8") as file:
            content = file.read()
    shipped = docs.sparkSession.sparkContext.broadcast(content)
    key = hashlib.sha256(content.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(f"codec {key}", lambda: Codec(shipped.value))
        for batch in batches:
            for part, _, _ in pieces(batch, 1, SLICE_BYTES):
                texts = [codec.pieces(t) for t in part.column(1).to_pylist()]
                codec.learn(set().union(*texts))
                yield (_digest if digests else _plain)(codec, part.column(0), texts)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "doc_id long, ids array<int>, decoded string"
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, schema)


def _plain(codec: Codec, doc_id: pa.Array, texts: list[list[str]]) -> pa.RecordBatch:
    ids = [codec.ids(words) for words in texts]
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array(ids, pa.list_(pa.int32())), pa.array([codec.decode(i) for i in ids], pa.string())],
        names=["doc_id", "ids", "decoded"],
    )


def _digest(codec: Codec, doc_id: pa.Array, texts: list[list[str]]) -> pa.RecordBatch:
    n, ids_sha, decoded_sha = [], [], []
    for words in texts:
        known = [codec.known[w] for w in words]
        ids = b" ".join([k[0] for k in known])
        n.append(ids.count(b" ") + 1 if known else 0)
        ids_sha.append(hashlib.sha256(ids).hexdigest())
        decoded_sha.append(hashlib.sha256(b" ".join([k[1] for k in known])).hexdigest())
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )
