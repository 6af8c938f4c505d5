"""SentencePiece encoding and decoding, with a max-plus parallel scan over huge texts.

The model is of the BPE kind: a segmentation is the library's answer exactly if
each two neighbouring pieces are the answer for their own joint text.  So an
answer is a path through the lattice of pieces on which every step between
neighbours weighs 0 if they go together and minus infinity if not, and the
answer is the only path of weight 0; sums of piece scores, the usual weights of
a lattice, would give other pieces than the library's merges do.

A huge text is cut into chunks anywhere.  The states of a border are the pieces
that begin before it and end at it or beyond.  Each chunk gives the matrix of
best weights from the states of its left border to those of its right one; a
product that takes the maximum over sums combines them, in any grouping; the
states that lie on the best path follow from the products before and after each
border, and each chunk then traces its own part back by itself.  No piece
crosses to a character that never follows another one in a piece, such as the
blank that starts a word; past the first such place in a chunk all states share
one way, and what stands between two of them is solved once and remembered.

NULL and empty texts have no pieces; a NULL text decodes to NULL.  Characters
that no piece holds become the bytes' pieces.  Decoding gives back the text, but
for U+2581, which the model reads as a blank.  Rows are handled one by one.
"""

import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensura.llm import segments as sg
from mensura.llm import text as tx
from mensura.session import scratch

# Fixed value: the mark of a blank.
BLANK = "▁"
CHUNK = 64 << 10
PAIRS, WORDS = 1 << 17, 1 << 19  # pairs of pieces and words that a Python worker remembers
SOLVED = 1 << 18  # words of huge texts that it remembers
NEVER = -np.inf


class Pieces:
    """The vocabulary, and which pieces go together."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        self.ids = {model.id_to_piece(i): i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in every if model.is_byte(i)}
        self.longest = max(map(len, self.ids))
        self.pairs: dict[str, dict[str, bool]] = {}
        self.known = 0
        #: Neighbours that some piece holds; a text can be cut between any others.
        self.joined = {p[k - 1 : k + 1] for p in self.ids for k in range(1, len(p))}
        held = {c for p in self.ids for c in p}
        self.may_join = np.ones((256, 256), bool)
        for x in range(128):
            for y in range(128):
                self.may_join[x, y] = (chr(x) + chr(y)).replace(" ", BLANK) in self.joined
            if chr(x) not in held and x != 0x20:
                self.may_join[x, :] = self.may_join[:, x] = False
        self.may_join[0x80:, 0x20] = False
        crossing = any(p[k] == BLANK != p[k - 1] for p in self.ids for k in range(1, len(p)))
        if crossing or not self.bytes:
            raise ValueError("no piece may hold a blank after another character, and every byte needs a piece")

    def together(self, left: str, right: str) -> bool:
        """Whether two pieces (the first may be empty) are the answer for their joint text.

        The best-scored neighbours join, the leftmost of equals first; a join across
        the border, or parts left over, mean that they are not.
        """
        scores, parts, inner = self.scores, list(left + right), len(left)
        while True:
            best, at = NEVER, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1], NEVER)
                if score > best:
                    best, at = score, i
            if at < 0:
                return len(parts) == (2 if left else 1)
            if at == inner - 1:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            inner -= at < inner

    def after(self, left: str) -> dict[str, bool]:
        """What is known of the pieces that may follow a piece."""
        found = self.pairs.get(left)
        if found is None:
            if self.known >= PAIRS:
                self.pairs, self.known = {}, 0
            found = self.pairs[left] = {}
        return found

    def ways(self, text: str, start: int, stop: int, left: str) -> list[str | None]:
        """For each place up to `stop`, the last piece of the path of weight 0 from `start`, after the piece `left`; None without one.

        There is at most one path to each place, since a text has one answer.
        """
        ids, longest = self.ids, self.longest
        last: list[str | None] = [None] * (stop - start + 1)
        last[0] = left
        follow: list[dict | None] = [None] * len(last)
        follow[0] = self.after(left)
        for p in range(1, len(last)):
            end = start + p
            for q in range(p - longest if p > longest else 0, p):
                known = follow[q]
                if known is None:
                    continue
                piece = text[start + q : end]
                if piece in ids or q == p - 1:
                    fits = known.get(piece)
                    if fits is None:
                        fits = known[piece] = self.together(last[q], piece)
                        self.known += 1
                    if fits:
                        last[p] = piece
                        follow[p] = self.after(piece)
                        break
        return last

    def word(self, text: str) -> list[str]:
        """Pieces of a text that begins at a cut."""
        return traced(self.ways(text, 0, len(text), ""), len(text))

    def number(self, piece: str) -> list[int]:
        found = self.ids.get(piece)
        return [found] if found is not None else [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]

    def word_ids(self, words: list[bytes]) -> list[list[int]]:
        out = []
        for raw in words:
            pieces = self.word(raw.decode("utf-8", "replace").replace(" ", BLANK))
            out.append([n for p in pieces for n in self.number(p)])
        return out

    @cached_property
    def memo(self) -> sg.Memo:
        """Ids of the words of short texts."""
        return sg.Memo(self.word_ids, WORDS)

    @cached_property
    def solve(self):
        """Pieces of parts of huge texts."""
        return solver(self)


@lru_cache(maxsize=2)
def kept_pieces(path: str) -> Pieces:
    """The vocabulary of this Python worker, which Spark reuses for many tasks: what one task learns of words spares the next ones."""
    return Pieces(path)


class Decoder:
    """Bytes of all pieces in one array, so that ids turn into bytes array-wise."""

    def __init__(self, pieces: Pieces):
        size = max(max(pieces.ids.values()), max(pieces.bytes.values())) + 1
        raw = [b""] * size
        for piece, i in pieces.ids.items():
            raw[i] = piece.replace(BLANK, " ").encode()
        for byte, i in pieces.bytes.items():
            raw[i] = bytes([byte])
        self.sizes = np.array([len(x) for x in raw])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(raw), np.uint8)

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Text of the ids between each two bounds, without the blank that encoding put first."""
        sizes = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        raw = self.flat[np.repeat(self.starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        at = ends[bounds].tolist()
        return [raw[a:b].decode("utf-8", "replace")[1:] for a, b in zip(at, at[1:], strict=False)]


@lru_cache(maxsize=2)
def kept_decoder(path: str) -> Decoder:
    """The bytes of all pieces, for this Python worker; the vocabulary itself is not kept for them."""
    return Decoder(Pieces(path))


def traced(last: list[str | None], place: int) -> list[str]:
    """The pieces up to a place, from the last one of each."""
    out = []
    while place > 0:
        piece = last[place]
        out.append(piece)
        place -= len(piece)
    return out[::-1]


def with_first_blank(block: tx.Block) -> tx.Block:
    """The block with a blank before every text that is not empty, and U+2581 read as a blank."""
    texts = [block.text(i) for i in range(len(block))]
    raw = [b" " + t.replace(BLANK.encode(), b" ") if t else t for t in texts]
    joined = b"".join(raw)
    data = np.zeros(len(joined) + 8, np.uint8)
    data[: len(joined)] = np.frombuffer(joined, np.uint8)
    return tx.Block(block.lo, block.hi, data, np.concatenate([[0], np.cumsum([len(t) for t in raw], dtype=np.int64)]))


def cuts(data: np.ndarray, may_join: np.ndarray) -> np.ndarray:
    """Marks the bytes that no piece crosses to, as far as single bytes tell."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[1:-1] = ~may_join[data[:-1], data[1:]]
    return cut


def checksum(ids: np.ndarray, before: int = 0) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes(), before)


def _encode_short(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of texts of one chunk."""
    pieces = kept_pieces(path)
    memo = pieces.memo
    for batch in batches:
        for block in tx.blocks(batch, "__text", size=tx.BLOCK_BYTES // 2):
            padded = with_first_blank(block)
            starts, ends, first = sg.spans(padded, cuts(padded.data[: padded.n_bytes], pieces.may_join))
            flat, sizes = memo.ids(memo.entries(padded.data, starts, ends))
            bounds = np.concatenate([[0], np.cumsum(sizes)])[first]
            ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("__row").slice(block.lo, len(block)), ids], names=["__row", "ids"])


def _chunks(chunk: int, reach: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each chunk of a huge text, with `reach` characters of its neighbours on both sides."""
    for batch in batches:
        for i in range(batch.num_rows):
            text = " " + batch.column("__text")[i].as_py().replace(BLANK, " ")
            count = max(1, len(text) // chunk)  # the last chunk takes the rest, so none is shorter than `chunk`
            for k in range(count):
                a, b = k * chunk, (k + 1) * chunk if k + 1 < count else len(text)
                lo = max(0, a - reach)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("number").slice(i, 1), *(pa.array([x], pa.int64()) for x in (k, count, a - lo, b - lo)), pa.array([text[lo : b + reach]])],
                    names=["number", "chunk", "chunks", "a", "b", "piece"],
                )


State = tuple[int, int, str]  # start and end of a piece, counted from the border, and the piece


def states(pieces: Pieces, text: str, border: int) -> list[State]:
    """Pieces that begin before the border and end at it or beyond; at the start of a text nothing does."""
    if border == 0:
        return [(0, 0, "")]
    out = []
    for i in range(max(0, border - pieces.longest), border):
        for j in range(border, min(len(text), i + pieces.longest) + 1):
            if text[i:j] in pieces.ids or j - i == 1:
                out.append((i - border, j - border, text[i:j]))
    return out


def stops(text: str, joined: set[str]) -> list[int]:
    """Places inside a piece of text that no vocabulary piece crosses."""
    return [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in joined]


class Chunk:
    """One chunk: `text` with blanks marked, its borders at `a` and `b`."""

    def __init__(self, pieces: Pieces, text: str, a: int, b: int, solve):
        self.pieces, self.a, self.b = pieces, a, b
        self.text = text.replace(" ", BLANK)
        self.lefts, self.rights = states(pieces, self.text, a), states(pieces, self.text, b)
        within = [s for s in stops(self.text, pieces.joined) if a <= s <= b]
        self.first, self.last = (within[0], within[-1]) if within else (None, None)
        self.solve = solve
        self.reach = max((j for _, j, _ in self.rights), default=0) + b

    def head(self, state: State, to: int) -> list[str | None] | None:
        start = self.a + state[1]
        return self.pieces.ways(self.text, start, to, state[2]) if start <= to else None

    def tail(self) -> list[str | None]:
        return self.pieces.ways(self.text, self.last, self.reach, "")

    def reached(self, last: list[str | None], start: int) -> np.ndarray:
        """Weight of each right state, given the last pieces from a start on."""
        out = np.full(len(self.rights), NEVER)
        for n, (i, j, piece) in enumerate(self.rights):
            at = self.b + j - start
            if self.b + i >= start and 0 < at < len(last) and last[at] == piece:
                out[n] = 0.0
            # A piece that crosses both borders was the left state itself; chunks are longer than that.
        return out

    def matrix(self) -> np.ndarray:
        out = np.full((len(self.lefts), len(self.rights)), NEVER)
        tail = None
        for n, state in enumerate(self.lefts):
            if self.first is None:
                last = self.head(state, self.reach)
                if last is not None:
                    out[n] = self.reached(last, self.a + state[1])
                continue
            last = self.head(state, self.first)
            if last is not None and last[-1] is not None:
                if tail is None:
                    # At a cut on the border itself, the state is the piece that ends there.
                    ends_there = np.array([0.0 if j == 0 else NEVER for _, j, _ in self.rights]) if self.last == self.b else None
                    tail = self.reached(self.tail(), self.last) if ends_there is None else None
                out[n] = tail if tail is not None else self.closing(last, state)
        return out

    def closing(self, head: list[str | None], state: State) -> np.ndarray:
        """Weights where a cut lies right on the border: the piece that ends there decides."""
        ending = self.ending(head, state)
        return np.array([0.0 if j == 0 and piece == ending else NEVER for _, j, piece in self.rights])

    def ending(self, head: list[str | None], state: State) -> str:
        """The piece that ends at the last cut."""
        if self.first == self.last:
            return head[-1] if len(head) > 1 else state[2]
        return self.solve(self.text[self.first : self.last])[-1]

    def path(self, left: int, right: int) -> list[str]:
        """The pieces that begin in the chunk, on the path between two states."""
        state, (_, j, _) = self.lefts[left], self.rights[right]
        start = self.a + state[1]
        if self.first is None:
            return traced(self.head(state, self.reach), self.b + j - start)
        head = self.head(state, self.first)
        out = traced(head, len(head) - 1)
        out += self.solve(self.text[self.first : self.last])
        return out + traced(self.tail(), self.b + j - self.last)


def solver(pieces: Pieces):
    """Pieces of a text that begins and ends at cuts, part by part."""
    known: dict[str, list[str]] = {}

    def solve(text: str) -> list[str]:
        if len(known) > SOLVED:
            known.clear()
        places = [0, *stops(text, pieces.joined), len(text)]
        out = []
        for i, j in zip(places, places[1:], strict=False):
            word = text[i:j]
            if word not in known:
                known[word] = pieces.word(word)
            out += known[word]
        return out

    return solve


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product: the best sum over the states between."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1) if a.shape[1] else np.full((a.shape[0], b.shape[1]), NEVER)


def prefixes(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first matrices, by halves: pairs are combined, scanned, and spread again."""
    if len(matrices) < 2:
        return list(matrices)
    pairs = [combined(a, b) for a, b in zip(matrices[::2], matrices[1::2], strict=False)]
    whole = prefixes(pairs)
    out = [matrices[0]]
    for i in range(1, len(matrices)):
        out.append(whole[i // 2] if i % 2 else combined(whole[i // 2 - 1], matrices[i]))
    return out


def chosen(matrices: list[np.ndarray]) -> list[int]:
    """State of each border, the first and last included, on the best path from start to end."""
    before = [np.zeros((1, matrices[0].shape[0])), *prefixes(matrices)]
    after = [m.T for m in prefixes([m.T for m in reversed(matrices)])][::-1]
    # The last border's states are those that end with the text; the path ends in the best of them.
    end = int(np.argmax(before[-1][0]))
    total = [b[0] + a[:, end] for b, a in zip(before[:-1], after, strict=True)] + [before[-1][0]]
    return [int(np.argmax(t)) for t in total[:-1]] + [end]


def _matrices(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = kept_pieces(path)
    for batch in batches:
        cells = []
        for r in batch.select(["a", "b", "piece"]).to_pylist():
            chunk = Chunk(pieces, r["piece"], r["a"], r["b"], pieces.solve)
            m = chunk.matrix()
            cells.append((m.shape[0], m.shape[1], np.packbits(m == 0).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in ("number", "chunk")), pa.array([c[0] for c in cells], pa.int64()), pa.array([c[1] for c in cells], pa.int64()), pa.array([c[2] for c in cells], pa.binary())],
            names=["number", "chunk", "n", "m", "cells"],
        )


def _choose(table: pa.Table) -> pa.Table:
    rows = table.sort_by("chunk").to_pylist()
    matrices = [np.where(np.unpackbits(np.frombuffer(r["cells"], np.uint8), count=r["n"] * r["m"]).reshape(r["n"], r["m"]), 0.0, NEVER) for r in rows]
    at = chosen(matrices)
    return pa.table({"number": table.column("number"), "chunk": pa.array([r["chunk"] for r in rows], pa.int64()), "left": pa.array(at[:-1], pa.int64()), "right": pa.array(at[1:], pa.int64())})


def _trace(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = kept_pieces(path)
    for batch in batches:
        ids = []
        for r in batch.select(["a", "b", "piece", "left", "right"]).to_pylist():
            chunk = Chunk(pieces, r["piece"], r["a"], r["b"], pieces.solve)
            ids.append([n for p in chunk.path(r["left"], r["right"]) for n in pieces.number(p)])
        yield pa.RecordBatch.from_arrays([batch.column("number"), batch.column("chunk"), pa.array(ids, pa.list_(pa.int32()))], names=["number", "chunk", "ids"])


def encode(spark: SparkSession, documents: DataFrame, model: str, chunk: int = CHUNK, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns to keep of every row, and `ids`.  Texts beyond one chunk of characters are spread over tasks."""
    rows = documents.select(F.struct(*keep).alias("__row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    kept = rows.select("__row").schema["__row"].dataType
    row_and_ids = rows.select("__row").schema.add("ids", T.ArrayType(T.IntegerType()))
    short = rows.where(F.length("__text") < chunk).mapInArrow(partial(_encode_short, model), row_and_ids)
    path = scratch(spark, "huge-texts")
    rows.where(F.length("__text") >= chunk).select(F.monotonically_increasing_id().alias("number"), "__row", "__text").write.parquet(path)
    huge = spark.read.schema(rows.select("__row").schema.add("number", "long").add("__text", "string")).parquet(path)
    reach = kept_pieces(model).longest
    cut = huge.select("number", "__text").mapInArrow(partial(_chunks, chunk, reach), "number long, chunk long, chunks long, a long, b long, piece string").repartition("number", "chunk")
    found = cut.mapInArrow(partial(_matrices, model), "number long, chunk long, n long, m long, cells binary")
    states_of = found.groupBy("number").applyInArrow(lambda table: _choose(table), "number long, chunk long, left long, right long")
    traced_ids = cut.join(states_of, ["number", "chunk"]).mapInArrow(partial(_trace, model), "number long, chunk long, ids array<int>")
    whole = traced_ids.groupBy("number").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"))
    long = huge.select("number", F.col("__row").cast(kept).alias("__row")).join(whole, "number").select("__row", "ids")
    return short.unionByName(long).select("__row.*", "ids")


def _decode(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    decoder = kept_decoder(path)
    for batch in batches:
        keep = [i for i, n in enumerate(batch.schema.names) if n != "ids"]
        column = batch.column("ids")
        null = column.is_null()
        bounds = np.concatenate([[0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        ids = column.flatten().to_numpy(zero_copy_only=False)
        texts: list[str] = []
        lo = 0
        while lo < len(bounds) - 1:  # about a million ids at a time
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + (1 << 20), side="right")) - 1)
            texts += decoder.texts(ids[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
            lo = hi
        sums = [checksum(ids[a:b]) for a, b in zip(bounds.tolist(), bounds.tolist()[1:], strict=False)]
        decoded = pa.compute.if_else(null, pa.scalar(None, pa.string()), pa.array(texts, pa.string()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in keep), pa.array(np.diff(bounds)), pa.array(sums, pa.int64()), decoded],
            names=[*(batch.schema.names[i] for i in keep), "n_pieces", "ids_crc32", "decoded"],
        )


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The other columns, the number of ids, their checksum as 32-bit integers, and `decoded`."""
    schema = encoded.drop("ids").schema.add("n_pieces", "long").add("ids_crc32", "long").add("decoded", "string")
    return encoded.mapInArrow(partial(_decode, model), schema)


def round_trip(spark: SparkSession, documents: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, decoded_sha256 and whether decoding gave the text back, of every row."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), BLANK, " ")
    named = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"), "text")
    decoded = decode(encode(spark, named, model, keep=("doc_id", "text_sha256")), model)
    return decoded.select(
        "doc_id", "n_pieces", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("same_text"),
    )
