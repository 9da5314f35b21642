"""Token counts from a compiled finite-state transducer.

A merge-ranked vocabulary is compiled into a deterministic transducer over characters. What the encoder has read so far
matters only through the vocabulary pieces that may still be open: for each start of such a piece the state holds its
place in the piece tree, the token before that start, and how many tokens fewer stand before it than now. Reading
a character ends exactly one piece that may follow its predecessor (two neighbouring tokens may stand together if
encoding their joined text gives these two), and the difference of token counts is what the transition emits. States
and transitions are made when first met and kept for later texts, up to `max_states`; then the table starts anew.

Texts are cut into chunks, and chunks at word borders: no piece goes over a border from other characters to a
blank, so behind a border every state has become the start state and the map of a chunk is a constant. A chunk is
thus the pair of what stands before its first and behind its last border, and the tokens between. These maps compose
associatively: a running count over the chunks of a text (a window, the prefix scan) says which ends meet, the ends
are joined and counted by the same transducer, and all counts add up. Only the ends are shuffled.

Edge cases: null and empty texts have no tokens. Rows of one id are told apart by their texts. Characters without a
piece count as their bytes, as the byte fallback gives them. Models with another normaliser than the identity, without
byte fallback or with pieces over word borders are refused.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywire.llm.text import once_per_worker, ship_code, text_key

ship_code(__name__)

BLANK = "▁"
WORDS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
CHUNK_CHARS = 32768


class Transducer:
    """Lazily determinised: `states` are the tuples of open pieces; each has a table from characters to the next
    state's table and the emitted tokens, and its own number under the empty string.

    The token before an open piece is kept only while more than `few` pieces may still come out of it; then the
    set of those that may follow the token takes its place, so states that behave alike are one state.
    """

    def __init__(self, pieces: Iterable[str], max_states: int = 120_000, max_words: int = 200_000, few: int = 24):
        self.rank = {piece: i for i, piece in enumerate(pieces)}
        self.max_states, self.max_words = max_states, max_words
        #: the last merge that makes a piece; a piece that other merges break up never comes out
        self.halves: dict[str, tuple[str, str]] = {}
        self.root: list = [{}, None, None]  # children by character, the piece that ends here, pieces below if few
        for piece in self.rank:
            trace = self.merges(piece)
            if len(piece) > 1:
                if not trace or "".join(trace[-1]) != piece:
                    continue
                self.halves[piece] = trace[-1]
            node = self.root
            for char in piece:
                node = node[0].setdefault(char, [{}, None, None])
            node[1] = piece
        self._below(self.root, few)
        self.words: dict[str, int] = {}
        self._clear()

    def _below(self, node: list, few: int) -> list[str]:
        pieces = [node[1]] if node[1] is not None else []
        for child in node[0].values():
            pieces += self._below(child, few)
        if len(pieces) <= few:
            node[2] = tuple(pieces)
        return pieces

    def _clear(self) -> None:
        for table in getattr(self, "tables", ()):
            table.clear()  # they refer to each other
        self.states: list[tuple] = [((self.root, None, None, 0),)]
        self.tables: list[dict] = [{"": 0}]
        self.number: dict[tuple, int] = {}
        self.allowed: dict[tuple, frozenset] = {}

    def merges(self, text: str) -> list[tuple[str, str]]:
        """Encoding by definition: merge the best-ranked neighbours, leftmost first, until none merge."""
        parts, done = list(text), []
        while True:
            pairs = ((self.rank[p], i) for i, p in enumerate(map("".join, zip(parts, parts[1:]))) if p in self.rank)
            best = min(pairs, default=None)
            if best is None:
                return done
            i = best[1]
            done.append((parts[i], parts[i + 1]))
            parts[i : i + 2] = ["".join(done[-1])]

    def may_stand(self, last: str | None, piece: str) -> bool:
        """Whether encoding the joined text of two pieces gives these two.

        Their merges are undone from the last one back. What meets at the border at that time must not have merged
        before; at equal rank the left place goes first.
        """
        if last is None:
            return True
        before = len(self.rank)
        while True:
            joined = self.rank.get(last + piece)
            if joined is not None and joined < before:
                return False
            left = self.rank[last] if last in self.halves else -1
            right = self.rank[piece] if piece in self.halves else -1
            if left > right:
                before, last = left, self.halves[last][1]
            elif right >= 0:
                before, piece = right + 1, self.halves[piece][0]
            else:
                return True

    def _followers(self, node: list, last: str | None, among: frozenset | None) -> frozenset:
        """Pieces at or below the node that may come after `last`, or that are in `among`."""
        key = (id(node), last, among)
        found = self.allowed.get(key)
        if found is None:
            if among is None:
                found = frozenset(p for p in node[2] if self.may_stand(last, p))
            else:
                found = among.intersection(node[2])
            self.allowed[key] = found
        return found

    def _step(self, table: dict, char: str) -> tuple[dict, int]:
        """Make the transition: next state's table and emitted tokens."""
        if char not in self.rank:
            step = table[char] = (self.tables[0], len(char.encode()))
            return step
        still, ended = [], None
        for node, last, among, fewer in self.states[table[""]]:  # longest open piece first
            node = node[0].get(char)
            if node is None:
                continue
            piece = node[1]
            if node[2] is None:
                fits = piece is not None and ended is None and self.may_stand(last, piece)
                still.append((node, last, None, fewer))
            else:
                among = self._followers(node, last, among)
                fits = piece in among
                if len(among) > fits:
                    still.append((node, None, among, fewer))
            if fits and ended is None:
                ended = (piece, fewer + 1)
        piece, emitted = ended
        state = (*((node, last, among, fewer - emitted) for node, last, among, fewer in still), (self.root, piece, None, 0))
        name = tuple([(id(node), last, among, fewer) for node, last, among, fewer in state])
        to = self.number.get(name)
        if to is None:
            to = self.number[name] = len(self.states)
            self.states.append(state)
            self.tables.append({"": to})
        step = table[char] = (self.tables[to], emitted)
        return step

    def run(self, word: str) -> int:
        """Tokens of a word: the emissions from the start state on."""
        if len(self.states) > self.max_states:
            self._clear()
        table, total = self.tables[0], 0
        for char in word:
            try:
                table, emitted = table[char]
            except KeyError:
                table, emitted = self._step(table, char)
            total += emitted
        return total

    def count(self, words: list[str]) -> int:
        known, total = self.words, 0
        for word in words:
            n = known.get(word)
            if n is None:
                n = self.run(word)
                if len(word) <= 40:
                    if len(known) >= self.max_words:
                        known.clear()
                    known[word] = n
            total += n
        return total


def load_pieces(path: str) -> list[str]:
    """Pieces of a SentencePiece BPE model that merges may make, best first."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    if not any(model.is_byte(i) for i in ids):
        raise ValueError("the model has no byte fallback")
    probe = "  ﬁ  　a\tb "
    if model.normalize(probe).replace(BLANK, " ") != " " + probe:
        raise ValueError("the model normalises texts")
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    pieces = [model.id_to_piece(i) for i in sorted(plain, key=lambda i: -model.get_score(i))]
    if any(BLANK in piece.lstrip(BLANK) for piece in pieces):
        raise ValueError("pieces go over word borders")
    return pieces


def _chunk_maps(shared: Any):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = once_per_worker(shared, Transducer)
        # the tables are many and hold no garbage: looking through them again and again costs a quarter of the time
        gc.disable()
        try:
            yield from maps(transducer, batches)
        finally:
            gc.enable()

    def maps(transducer: Transducer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, inner, tails = [], [], []
            for number, text in zip(batch.column("_k").to_pylist(), batch.column("_chunk").to_pylist()):
                marked = (text or "").replace(" ", BLANK)
                if marked and number == 0:
                    marked = BLANK + marked
                words = WORDS.findall(marked)
                heads.append(words[0] if words else "")
                tails.append(words[-1] if len(words) > 1 else None)
                inner.append(transducer.count(words[1:-1]))
            columns = [batch.column("_id"), batch.column("_row"), batch.column("_k")]
            columns += [pa.array(heads, pa.string()), pa.array(inner, pa.int64()), pa.array(tails, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_row", "_k", "_head", "_inner", "_tail"])

    return work


def _seams(shared: Any):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = once_per_worker(shared, Transducer)
        for batch in batches:
            counts = [
                inner + transducer.count(WORDS.findall(text))
                for text, inner in zip(batch.column("_seam").to_pylist(), batch.column("_inner").to_pylist())
            ]
            columns = [batch.column("_id"), batch.column("_row"), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_row", "_tokens"])

    return work


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, n_bytes and n_tokens of every row of `docs`.

    The vocabulary is broadcast (the pieces of one model, less than a megabyte whatever the documents). A worker compiles
    it once, and the states it adds stay for its later tasks.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({"args": (load_pieces(model_path),)})
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_row"), text.alias("_text"))
    pieces = F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{CHUNK_CHARS}}}"), F.lit(0))
    chunks = keyed.select("_id", "_row", F.posexplode_outer(pieces).alias("_k", "_chunk"))
    chunks = chunks.withColumn("_k", F.coalesce("_k", F.lit(0)))
    maps = chunks.mapInArrow(
        _chunk_maps(shared), f"_id {kind}, _row long, _k int, _head string, _inner long, _tail string"
    ).dropDuplicates(["_id", "_row", "_k"])  # repeated rows have the same maps
    before = Window.partitionBy("_id", "_row").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    placed = maps.withColumn("_seen", F.coalesce(F.count("_tail").over(before), F.lit(0)))
    ends = placed.select(
        "_id",
        "_row",
        "_inner",
        "_k",
        F.posexplode(F.array("_head", "_tail")).alias("_side", "_end"),
        "_seen",
    ).where(F.col("_end").isNotNull())
    seams = ends.groupBy("_id", "_row", (F.col("_seen") + F.col("_side")).alias("_seam_no")).agg(
        F.array_sort(F.collect_list(F.struct("_k", "_end"))).alias("_ends"),
        F.sum(F.when(F.col("_side") == 0, F.col("_inner")).otherwise(0)).alias("_inner"),
    )
    return _totals(keyed, seams, shared, kind)


def _totals(keyed: DataFrame, seams: DataFrame, shared: Any, kind: str) -> DataFrame:
    joined = F.array_join(F.transform("_ends", lambda x: x["_end"]), "")
    # the tokens inside the chunks go along with the seams: the chunk maps are made once
    counted = seams.select("_id", "_row", joined.alias("_seam"), "_inner").mapInArrow(_seams(shared), f"_id {kind}, _row long, _tokens long")
    sums = counted.groupBy(F.col("_id").alias("_i"), F.col("_row").alias("_r")).agg(F.sum("_tokens").alias("n_tokens"))
    rows = keyed.select("_id", "_row", F.octet_length("_text").cast("long").alias("n_bytes"))
    return rows.join(sums, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_row") == F.col("_r"))).select("_id", "n_bytes", "n_tokens")
