"""Benchmark decontamination: a BM25 inverted index of test items, searched with block-max WAND.

The index holds, per term, its items with their impacts, the highest impact of each block of
``ITEMS_PER_BLOCK`` items, and the highest of all. Every document is cut into overlapping passages, twice
as long as the longest item and one such length apart, so that any stretch of an item's length lies whole
in one passage. Passages are queries; all items that score at least ``MIN_SHARE`` of what they score
against themselves are retrieved. As in block-max WAND, upper bounds decide what is scored: first a
passage's sum of the terms' highest impacts, then, per block, the sum of block maxima, and only what may
still reach a block's lowest threshold is scored in full; here for all passages of a portion at once. No bound
loses a result. A retrieved item counts as leaked when the passage also holds enough of the word pairs of
its question and of its answer.

Bounds: an index part is filled up to ``PART_ITEMS`` items and ``PART_BYTES`` of text (an item beyond that is a part
of its own); larger benchmarks take several parts, each a pass over the documents. The number of items, their mean
and longest length, and the number of items with a term are those of the whole benchmark in every part, so
results do not depend on the parts.

Items under ``MIN_WORDS`` words have too few word pairs for shares of them to mean anything. Such an item is leaked
where its whole word sequence stands in a document: score null, share and overlaps 1, ``n_passages`` the number
of places.

Defined results: null or empty documents and items, and items without words, match nothing. Repeated documents repeat their rows, repeated items are reported under
each id; a null ``doc_id`` or ``item_id`` is carried through. Empty tables give no rows. Text is compared in lower case,
without punctuation. ``drop_leaked`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillscope.llm.scratch import Scratch
from skillscope.llm.shipping import bound_batches, ship
from skillscope.llm.words import WordBatch, mixed, portions, rolling

K1, B = 1.2, 0.75
MIN_SHARE = 0.6
MIN_OVERLAP = 0.7  # of the word pairs of the question, and of those of the answer
MIN_WORDS = 8  # items with fewer are matched as whole sequences
ITEMS_PER_BLOCK = 64
PART_ITEMS, PART_BYTES = 5000, 16 << 20

# Letters, digits and all bytes beyond ASCII make up words here.
_TERM_BYTES = np.zeros(256, bool)
_TERM_BYTES[128:] = True
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _TERM_BYTES[_c] = True

MATCHES = "item_id long, score double, share double, question_overlap double, answer_overlap double, n_passages long"


def _words(texts: pa.Array) -> WordBatch:
    return WordBatch(pc.utf8_lower(texts), parts=_TERM_BYTES)


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mixed(hashes[:-1] * np.uint64(3) + mixed(hashes[1:]))


def _answer_start(text: str) -> int:
    """Characters before the answer: after a question mark or line break, else the last sentence."""
    body = text.rstrip()
    for mark in ("?", "\n", ". "):
        at = body.rfind(mark, 0, len(body) - 1)
        if at >= 0:
            return at + 1
    return 2 * len(body) // 3


@dataclass
class Index:
    """Postings in rows sorted by term; ``*_at`` give each term's range."""

    terms: np.ndarray
    best: np.ndarray
    block_at: np.ndarray
    block: np.ndarray
    block_best: np.ndarray
    post_at: np.ndarray
    post_item: np.ndarray
    post_impact: np.ndarray
    item_ids: np.ndarray
    needed: np.ndarray
    block_needed: np.ndarray
    self_score: np.ndarray
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    reach: int


@dataclass
class ShortItems:
    """Items under ``MIN_WORDS`` words: by length, the sorted hashes of their sequences and the ids of each."""

    by_length: dict[int, tuple[np.ndarray, list[list[int]]]]


@dataclass
class Part:
    """What a pass over the documents looks for."""

    index: Index | None
    short: ShortItems


@dataclass
class Totals:
    """Figures of the whole benchmark, of its items that are long enough; ``with_terms`` gives the number of items
    that hold each of the given terms."""

    n_items: int
    n_words: int
    longest: int
    with_terms: Callable[[np.ndarray], np.ndarray]


def build_index(items: list[tuple[int, str]], min_share: float = MIN_SHARE, totals: Totals | None = None) -> Index | None:
    """The index of (id, text) items, all of the benchmark or a part of it; None when no item is long enough."""
    texts = pa.array([t for _, t in items], pa.large_string())
    words = _words(texts)
    hashes = words.hashes()
    chosen = [i for i in np.argsort(words.counts, kind="stable") if words.counts[i] >= MIN_WORDS]
    if not chosen:
        return None
    sequences = [hashes[words.first[i]:words.first[i + 1]] for i in chosen]
    lengths = np.array([len(s) for s in sequences])
    item = np.repeat(np.arange(len(chosen)), lengths)
    terms, term = np.unique(np.concatenate(sequences), return_inverse=True)
    cell, tf = np.unique(term * len(chosen) + item, return_counts=True)
    term, item = cell // len(chosen), cell % len(chosen)
    totals = totals or Totals(len(chosen), int(lengths.sum()), int(lengths.max()), lambda _: np.bincount(term, minlength=len(terms)))
    df = totals.with_terms(terms)
    idf = np.log1p((totals.n_items - df + 0.5) / (df + 0.5))
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] * totals.n_items / totals.n_words))
    self_score = np.bincount(item, impact, len(chosen))
    needed = min_share * self_score
    n_blocks = -(-len(chosen) // ITEMS_PER_BLOCK)
    cells, where = np.unique(term * n_blocks + item // ITEMS_PER_BLOCK, return_inverse=True)
    block_best = np.zeros(len(cells))
    np.maximum.at(block_best, where, impact)
    best = np.zeros(len(terms))
    np.maximum.at(best, term, impact)
    questions, answers = [], []
    for i, sequence in zip(chosen, sequences, strict=True):
        text = items[i][1]
        cut = _words(pa.array([text[:_answer_start(text)]], pa.large_string())).counts[0]
        cut = min(max(int(cut), 2), len(sequence) - 2)
        questions.append(np.unique(_pairs(sequence[:cut])))
        answers.append(np.unique(_pairs(sequence[cut:])))
    return Index(
        terms, best, np.searchsorted(cells // n_blocks, np.arange(len(terms) + 1)), cells % n_blocks, block_best,
        np.searchsorted(term, np.arange(len(terms) + 1)), item, impact, np.array([items[i][0] for i in chosen], object),
        needed, np.minimum.reduceat(needed, np.arange(0, len(chosen), ITEMS_PER_BLOCK)), self_score, questions, answers,
        totals.longest)


def short_items(items: list[tuple[int, str]]) -> ShortItems:
    words = _words(pa.array([t for _, t in items], pa.large_string()))
    hashes = words.hashes()
    by_length: dict[int, dict[int, list[int]]] = {}
    for i in np.flatnonzero((words.counts > 0) & (words.counts < MIN_WORDS)):
        n = int(words.counts[i])
        key = int(rolling(hashes[words.first[i]:words.first[i + 1]], n)[0])
        by_length.setdefault(n, {}).setdefault(key, []).append(items[i][0])
    return ShortItems({n: (np.array(sorted(ids), np.uint64), [ids[key] for key in sorted(ids)]) for n, ids in by_length.items()})


def build_part(items: list[tuple[int, str]], min_share: float = MIN_SHARE, totals: Totals | None = None) -> Part | None:
    """All that is needed to find the items; None when none of them has words."""
    part = Part(build_index(items, min_share, totals), short_items(items))
    return part if part.index or part.short.by_length else None


def _spread(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges, and the range of each."""
    sizes = stops - starts
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner] + starts[owner], owner


def retrieve(index: Index, passage: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """(passage, item, score) of all items above their thresholds, for distinct (passage, term) pairs."""
    bound = np.bincount(passage, index.best[term], n)
    live = bound >= index.needed.min()
    keep = live[passage]
    passage, term = passage[keep], term[keep]
    n_blocks, n_items = len(index.block_needed), len(index.item_ids)
    names = np.flatnonzero(live)
    number = np.searchsorted(names, passage)
    at, owner = _spread(index.block_at[term], index.block_at[term + 1])
    bounds = np.bincount(number[owner] * n_blocks + index.block[at], index.block_best[at], len(names) * n_blocks)
    open_blocks = bounds.reshape(-1, n_blocks) >= index.block_needed
    keep = open_blocks.any(axis=1)[number]
    number, term = number[keep], term[keep]
    at, owner = _spread(index.post_at[term], index.post_at[term + 1])
    item, number = index.post_item[at], number[owner]
    keep = open_blocks[number, item // ITEMS_PER_BLOCK]
    cells, where = np.unique(number[keep] * n_items + item[keep], return_inverse=True)
    scores = np.bincount(where, index.post_impact[at[keep]], len(cells))
    good = scores >= index.needed[cells % n_items] * (1 - 1e-12)
    return names[cells[good] // n_items], cells[good] % n_items, scores[good]


def _overlap(wanted: np.ndarray, held: np.ndarray) -> float:
    return float(np.isin(wanted, held).mean())


def search(part: Part, texts: pa.Array, min_overlap: float = MIN_OVERLAP) -> list[tuple]:
    """(row, item_id, score, share, question_overlap, answer_overlap, n_passages) of all leaks."""
    out = []
    for offset, portion in portions(texts):
        words = _words(portion)
        hashes = words.hashes()
        if not len(hashes):
            continue
        out += [(offset + r, *leak) for r, *leak in _short_leaks(part.short, words, hashes)]
        if part.index:
            out += [(offset + r, *leak) for r, *leak in _long_leaks(part.index, words, hashes, min_overlap)]
    return sorted(out, key=lambda leak: (leak[0], leak[1] is None, leak[1] or 0))


def _short_leaks(short: ShortItems, words: WordBatch, hashes: np.ndarray) -> Iterator[tuple]:
    """Short items that stand in a text as a whole, with their number of places."""
    row = np.repeat(np.arange(len(words.counts)), words.counts)
    for n, (keys, ids) in short.by_length.items():
        sequences = rolling(hashes, n)
        at = np.minimum(np.searchsorted(keys, sequences), len(keys) - 1)
        at, first = at[good := keys[at] == sequences], np.flatnonzero(good)
        inside = row[first] == row[first + n - 1]
        cells, places = np.unique(row[first[inside]] * len(keys) + at[inside], return_counts=True)
        for cell, count in zip(cells, places, strict=True):
            for item in ids[cell % len(keys)]:
                yield int(cell // len(keys)), item, None, 1.0, 1.0, 1.0, int(count)


def _long_leaks(index: Index, words: WordBatch, hashes: np.ndarray, min_overlap: float) -> Iterator[tuple]:
    """Items that the index retrieves for a passage of a text and whose word pairs it holds."""
    out: dict[tuple[int, int], list] = {}
    row = np.repeat(np.arange(len(words.counts)), words.counts)
    cut = (np.arange(len(row)) - words.first[:-1][row]) // index.reach
    base = np.concatenate([[0], np.cumsum(-(-words.counts // index.reach))])
    found = np.searchsorted(index.terms, hashes)
    found[found == len(index.terms)] = 0
    known = np.flatnonzero(index.terms[found] == hashes)
    # Passage k of a text covers pieces k and k+1.
    own = base[row[known]] + cut[known]
    earlier = known[cut[known] > 0]
    n_terms = len(index.terms)
    pairs = np.unique(np.concatenate([own * n_terms + found[known],
                                      (base[row[earlier]] + cut[earlier] - 1) * n_terms + found[earlier]]))
    passages, items, scores = retrieve(index, pairs // n_terms, pairs % n_terms, int(base[-1]))
    for passage, item, score in zip(passages, items, scores, strict=True):
        r = int(np.searchsorted(base, passage, "right")) - 1
        low = words.first[r] + (passage - base[r]) * index.reach
        held = np.unique(_pairs(hashes[low:min(low + 2 * index.reach, words.first[r + 1])]))
        question, answer = _overlap(index.questions[item], held), _overlap(index.answers[item], held)
        if min(question, answer) >= min_overlap:
            best = out.setdefault((r, int(item)), [0.0, 0.0, 0.0, 0])
            best[:] = [max(best[0], float(score)), max(best[1], question), max(best[2], answer), best[3] + 1]
    for (r, i), (s, q, a, n) in out.items():
        yield r, index.item_ids[i], s, s / float(index.self_score[i]), q, a, n


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct term of an item, the first of them with the item's number of words."""
    for batch in batches:
        words = _words(batch.column(0))
        hashes = words.hashes()
        for i in np.flatnonzero(words.counts >= MIN_WORDS):
            terms = np.unique(hashes[words.first[i]:words.first[i + 1]])
            counts = np.zeros(len(terms), np.int64)
            counts[0] = words.counts[i]
            yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts)], ["term", "n_words"])


def _totals(items: DataFrame, scratch: Scratch) -> Totals:
    ship()
    terms = items.select("text").mapInArrow(_item_terms, "term long, n_words long").groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"), F.max("n_words").alias("longest"),
        F.count_if(F.col("n_words") > 0).alias("firsts"))
    terms = scratch.keep(terms, "terms")
    whole = terms.agg(F.sum("firsts").alias("n"), F.sum("words").alias("words"), F.max("longest").alias("longest")).first()

    def with_terms(wanted: np.ndarray) -> np.ndarray:
        asked = items.sparkSession.createDataFrame(pa.table({"term": pa.array(wanted.view(np.int64))}))
        found = terms.join(asked, "term").select("term", "n").toArrow()
        known = found["term"].to_numpy().view(np.uint64)
        order = np.argsort(known)
        return found["n"].to_numpy()[order][np.searchsorted(known[order], wanted)]

    return Totals(whole["n"] or 0, whole["words"] or 0, whole["longest"] or 0, with_terms)


def _parts(rows: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    part, size = [], 0
    for row in rows:
        own = len(row[1].encode())
        if part and (len(part) == PART_ITEMS or size + own > PART_BYTES):
            yield part
            part, size = [], 0
        part.append(row)
        size += own
    yield part


def index_parts(benchmark: DataFrame, min_share: float = MIN_SHARE) -> Iterator[Part]:
    """Parts of bounded size that hold all items between them."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text IS NOT NULL")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    rows = items.orderBy("item_id", "text")
    if size["n"] <= PART_ITEMS and size["b"] <= PART_BYTES:
        if part := build_part([tuple(r) for r in rows.collect()], min_share):
            yield part
        return
    scratch = Scratch(benchmark.sparkSession, "benchmark")
    totals = _totals(items, scratch)
    for some in _parts(tuple(r) for r in rows.toLocalIterator()):
        if part := build_part(some, min_share, totals):
            yield part
    scratch.drop("terms")


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_share: float = MIN_SHARE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """A row for each document and item that it holds, with the best passage's figures."""
    ship()
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("share", pa.float64()),
                        ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("n_passages", pa.int64())])

    def searcher(part: Part):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = search(part, batch.column(1), min_overlap)
                ids = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                columns = list(zip(*[f[1:] for f in found], strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True))], schema=schema)
        return run

    found = None
    for part in index_parts(benchmark, min_share):
        one = rows.mapInArrow(searcher(part), f"doc_id long, {MATCHES}")
        found = one if found is None else found.unionAll(one)
    return docs.sparkSession.createDataFrame([], f"doc_id long, {MATCHES}") if found is None else found


def drop_leaked(docs: DataFrame, benchmark: DataFrame, min_share: float = MIN_SHARE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """``docs`` without the documents that hold a test item."""
    ship()
    bound_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def cleaner(part: Part):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaked = np.zeros(len(batch), bool)
                leaked[[f[0] for f in search(part, batch.column(at).cast(pa.string()), min_overlap)]] = True
                yield batch.filter(pa.array(~leaked))
        return run

    for part in index_parts(benchmark, min_share):
        docs = docs.mapInArrow(cleaner(part), docs.schema)
    return docs
