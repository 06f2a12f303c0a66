"""BPE by dynamic programming over prefixes.

The encoding of a word restricted to a prefix is the encoding of that prefix, so
each prefix has one last token.  It is the token that ends there and whose
predecessor, the last token of the prefix before it, could stand beside it: no
merge across their border comes before the merges that made the two.  An
Aho-Corasick automaton over the tokens, a trie of their prefixes with links to
suffixes, finds the longest one ending at each place in one pass, and links lead
on to the shorter ones; following the last tokens back from the end of the word
gives its ids.  It stands in for a suffix automaton: only whole tokens are looked
for, so states for their other substrings would serve nothing.
"""

from __future__ import annotations

import hashlib
import json
import string
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echoloom.workspace import send_with_tasks

send_with_tasks(__name__)

WORD_END = "</w>"
# Moves the last character of a word, so that it differs from the same one inside a word.
END_SHIFT = 0x10000
# Bounds on what a worker remembers: stretches of text (two generations of so many); words,
# starts of words and pairs of tokens (so many of each); and shortcuts between states.
MOST_CHUNKS = 200_000
MOST_CACHED = 100_000
MOST_SHORTCUTS = 100_000
LONGEST_CACHED = 64  # bytes
PREFIX = 5  # symbols of a word whose tokens are remembered for words that start alike
PUNCTUATION = string.punctuation
# The pieces a text is cut into, as the vocabulary's file states them.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def read_vocabulary(spark: SparkSession, path: str) -> str:
    """The vocabulary's JSON text, from the driver's disk or from a store only Spark reads."""
    if "://" in path:
        return spark.read.text(path, wholetext=True).first()[0]
    with open(path, encoding="utf-8") as file:
        return file.read()


def byte_characters() -> list[str]:
    """Printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    table = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


class WordBpe:
    """Encoder and decoder for a vocabulary with word ends."""

    def __init__(self, vocabulary: str):
        loaded = json.loads(vocabulary)
        model = loaded["model"]
        steps = [s["type"] for s in (loaded["normalizer"] or {}).get("normalizers", [])]
        if (
            model["type"] != "BPE"
            or model["end_of_word_suffix"] != WORD_END
            or steps != ["NFC", "Replace", "Lowercase"]
            or loaded["pre_tokenizer"]["pretokenizers"][0]["pattern"] != {"Regex": PIECES}
            or loaded["decoder"]
            or loaded["post_processor"]
        ):
            raise ValueError("only lower-case BPE with word ends and no decoder is supported")
        ids: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in loaded["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        self.bytes = byte_characters()
        # Rank of each pair of ids, and the pair each token was made of.
        self.ranks: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for rank, (left, right) in enumerate(map(tuple, model["merges"])):
            pair = (ids[left], ids[right])
            made = ids[left + right]
            self.ranks[pair] = rank
            self.halves.setdefault(made, pair)
            self.born.setdefault(made, rank)
        self._build_automaton(ids)
        self.pieces = regex.compile(PIECES)
        self.parts = regex.compile(
            "(" + "|".join(map(regex.escape, self.special)) + ")" if self.special else r"(?!)"
        )
        self._together: dict[int, bool] = {}
        self._words: dict[str, tuple[int, ...]] = {}
        self._prefixes: dict[str, tuple[int, list[int]]] = {}
        self._chunks: dict[bytes, tuple[int, ...]] = {}
        self._older: dict[bytes, tuple[int, ...]] = {}
        self._id_text = [str(i) for i in range(max(self.tokens) + 1)]
        self._token_text = [self.tokens.get(i, "") for i in range(max(self.tokens) + 1)]

    @staticmethod
    def _symbols(token: str) -> str:
        if token.endswith(WORD_END) and len(token) > len(WORD_END):
            token = token[: -len(WORD_END)]
            return token[:-1] + chr(ord(token[-1]) + END_SHIFT)
        return token

    def _build_automaton(self, ids: dict[str, int]) -> None:
        """States are the prefixes of tokens; the current one is the longest that the text ends with."""
        children: list[dict[str, int]] = [{}]
        ends: dict[int, int] = {}
        self.size = [0] * len(ids)
        for token, i in ids.items():
            state = 0
            symbols = self._symbols(token)
            for symbol in symbols:
                following = children[state].get(symbol)
                if following is None:
                    following = children[state][symbol] = len(children)
                    children.append({})
                state = following
            ends[state] = i
            self.size[i] = len(symbols)
        # Longest proper suffix of each state that is a state, shorter ones first.
        shorter_state = [0] * len(children)
        self.longest = [-1] * len(children)
        self.shorter = [-1] * len(ids)
        level = [0]
        while level:
            deeper = []
            for state in level:
                for symbol, following in children[state].items():
                    if state:
                        back = shorter_state[state]
                        while back and symbol not in children[back]:
                            back = shorter_state[back]
                        shorter_state[following] = children[back].get(symbol, 0)
                    inner = self.longest[shorter_state[following]]
                    token = ends.get(following, -1)
                    if token >= 0:
                        self.shorter[token] = inner
                    self.longest[following] = inner if token < 0 else token
                    deeper.append(following)
            level = deeper
        self._children, self._shorter_state = children, shorter_state
        self._shortcuts = 0

    def _move(self, state: int, symbol: str) -> int:
        """The state after ``symbol``; the first shortcuts found are kept beside the state's own children."""
        start = state
        while state and symbol not in self._children[state]:
            state = self._shorter_state[state]
        following = self._children[state].get(symbol, 0)
        if self._shortcuts < MOST_SHORTCUTS:
            self._children[start][symbol] = following
            self._shortcuts += 1
        return following

    def remembered(self) -> int:
        """Entries of all caches; never more than twice MOST_CHUNKS, three times MOST_CACHED and MOST_SHORTCUTS."""
        caches = (self._chunks, self._older, self._words, self._prefixes, self._together)
        return sum(map(len, caches)) + self._shortcuts

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` side by side stay two tokens.

        The merges that made the two are undone from the latest to the earliest.
        A pair that faces each other at the border exists from the later of its
        two births until the next merge on either side; if the pair's own merge
        falls before that, the border would not have survived.  On equal ranks
        the merge further left comes first.
        """
        ranks, halves, born = self.ranks, self.halves, self.born
        a, b = left, right
        never = len(ranks) + 1
        until_a, until_b = never, never
        verdict = True
        while True:
            rank = ranks.get((a, b))
            if rank is not None and rank < until_a and rank <= until_b:
                verdict = False
                break
            born_a, born_b = born.get(a, -1), born.get(b, -1)
            if born_a < 0 and born_b < 0:
                break
            if born_a >= born_b:
                until_a, a = born_a, halves[a][1]
            else:
                until_b, b = born_b, halves[b][0]
        if len(self._together) >= MOST_CACHED:
            self._together.clear()
        self._together[left << 20 | right] = verdict
        return verdict

    def encode_word(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece."""
        known = self._words.get(piece)
        if known is not None:
            return known
        if piece.isascii() and piece.isprintable():
            symbols = piece
        else:
            symbols = "".join([self.bytes[b] for b in piece.encode()])
        symbols = symbols[:-1] + chr(ord(symbols[-1]) + END_SHIFT)
        # last: the last token of every prefix, none for the empty one.
        start = symbols[:PREFIX]
        state, last = self._prefixes.get(start, (0, None)) if len(symbols) > PREFIX else (0, None)
        if last is None:
            last = [-1]
            if len(symbols) > PREFIX:
                state = self._extend(0, last, start)
                if len(self._prefixes) >= MOST_CACHED:
                    self._prefixes.clear()
                self._prefixes[start] = (state, last)
                last = last.copy()
                self._extend(state, last, symbols[PREFIX:])
            else:
                self._extend(0, last, symbols)
        else:
            last = last.copy()
            self._extend(state, last, symbols[PREFIX:])
        size = self.size
        end = len(symbols)
        found = []
        while end:
            token = last[end]
            found.append(token)
            end -= size[token]
        found = tuple(found[::-1])
        if len(piece) <= LONGEST_CACHED:
            if len(self._words) >= MOST_CACHED:
                self._words.clear()
            self._words[piece] = found
        return found

    def _extend(self, state: int, last: list[int], symbols: str) -> int:
        """Append the last token of each further prefix; the automaton's state after them."""
        moves, longest, shorter, size = self._children, self.longest, self.shorter, self.size
        together = self._together
        end = len(last) - 1
        for symbol in symbols:
            following = moves[state].get(symbol)
            state = self._move(state, symbol) if following is None else following
            token = longest[state]
            end += 1
            while True:
                before = last[end - size[token]]
                if before < 0:
                    break
                fits = together.get(before << 20 | token)
                if self.compatible(before, token) if fits is None else fits:
                    break
                token = shorter[token]
            last.append(token)
        return state

    def _encode_chunk(self, chunk: str) -> list[int] | tuple[int, ...]:
        found: list[int] = []
        for part in self.parts.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                found.append(self.special[part])
                continue
            if not part.isascii():
                # Lower case letter by letter: a final sigma is like any other.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            part = part.lower()
            letters = part.rstrip(PUNCTUATION)
            if letters.isalpha():  # a word, perhaps with marks after it: two pieces at most
                found.extend(self.encode_word(letters))
                if len(letters) < len(part):
                    found.extend(self.encode_word(part[len(letters) :]))
                continue
            for piece in self.pieces.findall(part):
                found.extend(self.encode_word(piece))
        return found

    def chunk(self, chunk: bytes) -> tuple[int, ...]:
        """Ids of a stretch without ASCII space."""
        known = self._chunks.get(chunk)
        if known is not None:
            return known
        known = self._older.get(chunk)
        if known is None:
            known = tuple(self._encode_chunk(chunk.decode()))
        if len(chunk) <= LONGEST_CACHED:
            # Two generations: what was used since the last turn survives the next.
            if len(self._chunks) >= MOST_CHUNKS:
                self._older, self._chunks = self._chunks, {}
            self._chunks[chunk] = known
        return known

    def texts(self, ids: list[int]) -> tuple[str, str]:
        """Decimal ids and decoded text, each joined by spaces."""
        numbers, names = self._id_text, self._token_text
        return " ".join([numbers[i] for i in ids]), " ".join([names[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; space only ever separates, so the stretches between are independent."""
        return [i for chunk in text.encode().split() for i in self._encode_chunk(chunk.decode())]

    def decode(self, ids: list[int]) -> str:
        """The vocabulary has no decoder, so its tokens are joined by spaces."""
        return " ".join([self._token_text[i] for i in ids])


class SharedBpe:
    """Built once in each Python worker that uses it, however many tasks that runs."""

    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary
        self._bpe: WordBpe | None = None

    def get(self) -> WordBpe:
        if self._bpe is None:
            self._bpe = WordBpe(self.vocabulary)
        return self._bpe


def encode_documents(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, ids array<int>, decoded string) of every whole text, row by row.

    Null and empty texts have no ids and an empty decoded text.  Nothing is
    shuffled; ``vocabulary`` (about 2 MB of JSON) is broadcast, and a task
    remembers a bounded number of words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(SharedBpe(vocabulary))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value.get()
        for batch in batches:
            ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
            decoded = [bpe.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                [key, "ids", "decoded"],
            )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    return narrow.mapInArrow(scan, f"`{key}` {kind}, ids array<int>, decoded string")


def encoded_digests(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    carried: Sequence[str] = (),
) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): what :func:`encode_documents` gives, hashed in the task.

    Columns of ``docs`` named in ``carried`` follow as they are.

    Ids and decoded text do not cross to the JVM.  Characters that Unicode added after the library's own
    tables may be cut differently.
    """
    shared = docs.sparkSession.sparkContext.broadcast(SharedBpe(vocabulary))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value.get()
        for batch in batches:
            counts, ids, decoded = [], [], []
            for value in batch.column(1).to_pylist():
                chunk = bpe.chunk
                found = [i for c in (value or b"").split() for i in chunk(c)]
                counts.append(len(found))
                for kept, joined in zip((ids, decoded), bpe.texts(found)):
                    kept.append(hashlib.sha256(joined.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.string()),
                    pa.array(decoded, pa.string()),
                    *(batch.column(2 + i) for i in range(len(carried))),
                ],
                [key, "n_tokens", "ids_sha256", "decoded_sha256", *carried],
            )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key), F.col(text).cast("binary").alias("_text"), *carried)
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    return narrow.mapInArrow(
        scan, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{more}"
    )
