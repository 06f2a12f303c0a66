"""Cross-entropy difference of a target and a background language model (Moore and Lewis 2010).

Both are bigram models over one vocabulary, smoothed alike, and the larger model's
counts are scaled to the mass of the smaller one, so that smoothing weighs the same
in both.  A document's score is the mean difference of its tokens' losses: the
lower, the more it reads like the target.  Counts are exact; documents meet them in
slices of the words and pairs, whose number grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.llm.sampling import word_counts
from echoloom.workspace import materialize, send_with_tasks

send_with_tasks(__name__)

SMOOTHING = 50.0  # tokens' worth of the unigram model mixed into each context
LEAST_COUNT = 0.1  # of every word in a unigram model
UNKNOWN, START = 0, 1
TOKENS_HELD = 500_000  # counted in a task before they are passed on
CHUNK_TOKENS = 500_000  # of the documents that are scored together
SLICE_TOKENS = 1_000_000  # whose pairs and words are added up together


@dataclass(frozen=True)
class Models:
    """What both models are counted from, and their sizes.

    ``background`` and ``wanted`` hold the texts as ``_text``; ``words`` is the vocabulary,
    ``others`` and ``target`` are the tokens of the background and the target.
    """

    background: DataFrame
    wanted: DataFrame
    words: DataFrame
    size: int
    others: int
    target: int
    known: frozenset[bytes] | None

    @property
    def numbers(self) -> dict[bytes, int]:
        """The vocabulary, numbered by use; for small vocabularies, as it comes to the driver."""
        words = sorted(self.words.collect(), key=lambda r: (-r["n"], r["word"]))
        return {bytes(r["word"]): i + 2 for i, r in enumerate(words)}


def token_numbers(text: bytes, known: frozenset[bytes] | None = None) -> np.ndarray:
    """A 64-bit number of each word; words that are not ``known``, if that is given, share one."""
    digest = xxhash.xxh64_intdigest
    words = text.lower().split()
    return np.array(
        [digest(w) if known is None or w in known else UNKNOWN for w in words], dtype=np.uint64
    ).view(np.int64)


def pair_numbers(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and 64-bit (context, token) numbers of a text; the first context is a start mark."""
    contexts = np.concatenate(([START], tokens[:-1])).astype(np.int64) if len(tokens) else tokens
    mixed = contexts.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(29)) + tokens.view(np.uint64)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return contexts, (mixed ^ mixed >> np.uint64(32)).view(np.int64)


@dataclass(frozen=True)
class Counts:
    """Distinct pairs and words of some tokens, sorted by their unsigned numbers, and their uses.

    A word is counted as such and as a context.
    """

    pairs: np.ndarray
    pair_uses: np.ndarray
    words: np.ndarray
    word_uses: np.ndarray
    context_uses: np.ndarray

    @classmethod
    def of(cls, texts: list[np.ndarray]) -> Counts:
        """Counts over texts that are given by their tokens' numbers."""
        none = np.zeros(0, dtype=np.int64)
        found = [pair_numbers(tokens) for tokens in texts]
        tokens = np.concatenate([none, *texts]).view(np.uint64)
        contexts = np.concatenate([none, *(c for c, _ in found)]).view(np.uint64)
        pairs = np.concatenate([none, *(p for _, p in found)]).view(np.uint64)
        pairs, pair_uses = np.unique(pairs, return_counts=True)
        words, place = np.unique(np.concatenate([tokens, contexts]), return_inverse=True)
        uses = (np.bincount(p, minlength=len(words)) for p in (place[: len(tokens)], place[len(tokens) :]))
        return cls(pairs, pair_uses, words, *uses)

    def ends(self, slices: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each slice of the numbers begins among ``pairs`` and ``words``, and the last one ends."""
        return tuple(
            np.searchsorted((v >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32), np.arange(slices + 1))
            for v in (self.pairs, self.words)
        )


def packed(values: np.ndarray) -> bytes:
    """Integers by byte planes: the leading bytes of sorted ones, and those of small ones, compress well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


SENT = ("pairs", "pair_uses", "words", "word_uses", "context_uses")
SENT_KIND = "slice int, _chunk bigint, role int, " + ", ".join(f"{c} binary" for c in SENT)
ANSWERED = ("pair_at", "pair_others", "pair_target", "word_at") + tuple(
    f"{kind}_{name}" for kind in ("word", "context") for name in ("others", "target")
)
ANSWER_KIND = "_chunk bigint, slice int, " + ", ".join(f"{c} binary" for c in ANSWERED)
# Who sends counts: documents to be scored that are the background's, or are not in the sums; the rest adds to them.
SCORED, ASKING, TARGET, OTHERS = range(4)


def sent_slices(counts: Counts, slices: int, chunk: int, role: int) -> pa.RecordBatch:
    """The counts as one row for each slice of the numbers."""
    pairs, words = counts.ends(slices)
    rows = [i for i in range(slices) if pairs[i] < pairs[i + 1] or words[i] < words[i + 1]]
    columns = [
        pa.array([packed(values[ends[i] : ends[i + 1]]) for i in rows], pa.binary())
        for values, ends in (
            (counts.pairs, pairs), (counts.pair_uses, pairs),
            (counts.words, words), (counts.word_uses, words), (counts.context_uses, words),
        )
    ]
    heads = [pa.array(rows, pa.int32()), pa.array([chunk] * len(rows), pa.int64()), pa.array([role] * len(rows), pa.int32())]
    return pa.RecordBatch.from_arrays([*heads, *columns], ["slice", "_chunk", "role", *SENT])


def answers(table: pa.Table) -> pa.Table:
    """For each chunk of a slice the sums of its pairs and words, where they are not the chunk's own."""
    roles = table.column("role").to_numpy()
    asking = np.flatnonzero((roles == SCORED) | (roles == ASKING))
    columns: dict[str, list[bytes]] = {name: [] for name in ANSWERED}
    for key, kinds in (("pair", ["pair"]), ("word", ["word", "context"])):
        parts = [unpacked(x) for x in table.column(f"{key}s").to_pylist()]
        ends = np.cumsum([0, *map(len, parts)])
        sizes = np.diff(ends)
        _, place = np.unique(np.concatenate(parts), return_inverse=True)
        role = np.repeat(roles, sizes)
        told = np.zeros(len(place), dtype=bool)
        sums = {}
        for kind in kinds:
            uses = np.concatenate([unpacked(x) for x in table.column(f"{kind}_uses").to_pylist()]).astype(np.int64)
            own = np.where(role == SCORED, uses, 0)
            others = np.bincount(place, np.where((role == SCORED) | (role == OTHERS), uses, 0))[place].astype(np.int64)
            target = np.bincount(place, np.where(role == TARGET, uses, 0))[place].astype(np.int64)
            told |= (others != own) | (target != 0)
            sums[kind] = others, target
        for i in asking:
            at = np.flatnonzero(told[ends[i] : ends[i + 1]])
            columns[f"{key}_at"].append(packed(at))
            for kind, (others, target) in sums.items():
                columns[f"{kind}_others"].append(packed(others[ends[i] + at]))
                columns[f"{kind}_target"].append(packed(target[ends[i] + at]))
    heads = [table.column(c).take(pa.array(asking)) for c in ("_chunk", "slice")]
    return pa.Table.from_arrays(
        [*heads, *(pa.array(columns[c], pa.binary()) for c in ANSWERED)], ["_chunk", "slice", *ANSWERED]
    )


def fit_models(
    docs: DataFrame, target: DataFrame, text: str = "text", least_share: float = 0.0
) -> Models:
    """The target's model from all texts of ``target``, the background's from all of ``docs``.

    All words are in the vocabulary.  With a ``least_share`` only those with that
    share of all tokens, at most as many as it goes into one, which come to the driver.
    Pairs are counted where documents are scored, so that they are sent once.
    """
    background, wanted = (df.select(F.col(text).cast("binary").alias("_text")) for df in (docs, target))
    words = materialize(word_counts(background.unionByName(wanted), "_text"), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    known = None
    if least_share > 0:
        words = words.filter(F.col("n") >= F.lit(least_share * total))
        known = frozenset(bytes(r["word"]) for r in words.collect())
    ours = word_counts(wanted, "_text").agg(F.sum("n")).first()[0] or 0
    return Models(background, wanted, words, words.count() + 2, total - ours, ours, known)


def losses(
    scale: float, total: int, size: int, counts: list[np.ndarray], own: list[np.ndarray] | None
) -> np.ndarray:
    """Loss of each token in bits, by the counts of its pair, context and word.

    With ``own`` the text's own counts of them are taken off first.
    """
    if own is not None:
        counts = [c - o for c, o in zip(counts, own)]
        total -= len(counts[0])
    pair, context, word = (np.maximum(c, 0) * scale for c in counts)
    unigram = (word + LEAST_COUNT) / (total * scale + LEAST_COUNT * size)
    return -np.log2((pair + SMOOTHING * unigram) / (context + SMOOTHING))


def score_documents(
    docs: DataFrame, models: Models, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_tokens, target_loss, background_loss, difference), mean losses in bits per token.

    ``docs`` are (some of) the documents of the background; their own counts are taken
    off it.  Texts without words, null ones included, have no tokens and zeros.
    Repeated rows are kept and get equal scores; an empty table gives none.

    Documents are dealt into chunks of about ``CHUNK_TOKENS``.  A chunk sends the counts of
    its distinct pairs and words to the slices of their numbers, as arrays; a slice adds up
    all chunks and the target and answers what differs from a chunk's own counts.
    """
    known, size = models.known, models.size
    totals = {"target": models.target, "others": models.others}
    least = min(max(1, n) for n in totals.values())
    chunks = max(1, -(-models.others // CHUNK_TOKENS))
    slices = max(1, -(-(models.others + models.target) // SLICE_TOKENS))
    # The background's own documents are counted as they are scored.
    role = SCORED if docs.select(F.col(text).cast("binary").alias("_text")).sameSemantics(models.background) else ASKING
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("_text"))
    dealt = narrow.withColumn(
        "_chunk", F.pmod(F.xxhash64("_key", "_text"), F.lit(chunks).cast("bigint"))
    ).groupBy("_chunk")

    def tokens_of(rows: pa.Table) -> list[np.ndarray]:
        return [token_numbers(value or b"", known) for value in rows.column("_text").to_pylist()]

    def counted(rows: pa.Table) -> pa.Table:
        chunk = rows.column("_chunk")[0].as_py()
        return pa.Table.from_batches([sent_slices(Counts.of(tokens_of(rows)), slices, chunk, role)])

    def scan(role: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in batches:
                for value in batch.column(0).to_pylist():
                    held.append(token_numbers(value or b"", known))
                    size += len(held[-1])
                    if size >= TOKENS_HELD:
                        yield sent_slices(Counts.of(held), slices, -1, role)
                        held, size = [], 0
            yield sent_slices(Counts.of(held), slices, -1, role)

        return run

    def own_counts(values: np.ndarray) -> np.ndarray:
        _, place, uses = np.unique(values, return_inverse=True, return_counts=True)
        return uses[place]

    def scored(rows: pa.Table, met: pa.Table) -> pa.Table:
        texts = tokens_of(rows)
        counts = Counts.of(texts)
        ends = dict(zip(("pair", "word"), counts.ends(slices)))
        begun = {"pair": counts.pair_uses, "context": counts.context_uses, "word": counts.word_uses}
        tables = {"target": {}, "others": {}}
        for kind, uses in begun.items():
            tables["target"][kind] = np.zeros(len(uses), dtype=np.int64)
            tables["others"][kind] = uses.astype(np.int64) if role == SCORED else np.zeros(len(uses), dtype=np.int64)
        for answer in met.to_pylist():
            for kind in begun:
                group = "pair" if kind == "pair" else "word"
                at = ends[group][answer["slice"]] + unpacked(answer[f"{group}_at"]).astype(np.int64)
                for name in totals:
                    tables[name][kind][at] = unpacked(answer[f"{kind}_{name}"]).astype(np.int64)
        found = []
        for tokens in texts:
            if not len(tokens):
                found.append((0, 0.0, 0.0, 0.0))
                continue
            contexts, numbers = pair_numbers(tokens)
            values = {"pair": numbers, "context": contexts, "word": tokens}
            at = {
                kind: np.searchsorted(counts.pairs if kind == "pair" else counts.words, v.view(np.uint64))
                for kind, v in values.items()
            }
            own = [own_counts(v) for v in values.values()]
            near, far = (
                losses(
                    least / max(1, totals[name]), totals[name], size, [tables[name][k][at[k]] for k in values], off
                )
                for name, off in (("target", None), ("others", own))
            )
            found.append((len(tokens), near.mean(), far.mean(), (near - far).mean()))
        columns = list(zip(*found)) if found else [()] * 4
        kinds = [pa.int64()] + [pa.float64()] * 3
        return pa.Table.from_arrays(
            [rows.column("_key"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            [key, "n_tokens", "target_loss", "background_loss", "difference"],
        )

    sent = dealt.applyInArrow(counted, SENT_KIND).unionByName(models.wanted.mapInArrow(scan(TARGET), SENT_KIND))
    if role == ASKING:
        sent = sent.unionByName(models.background.mapInArrow(scan(OTHERS), SENT_KIND))
    met = sent.groupBy("slice").applyInArrow(answers, ANSWER_KIND)
    kind = docs.schema[key].dataType.simpleString()
    return dealt.cogroup(met.groupBy("_chunk")).applyInArrow(
        scored,
        f"`{key}` {kind}, n_tokens bigint, target_loss double, background_loss double, difference double",
    )
