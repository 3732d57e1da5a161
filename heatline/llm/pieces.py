"""SentencePiece encoding and decoding by a streaming Viterbi search."""

import re
from array import array
from collections.abc import Iterator
from itertools import chain
from math import inf, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.llm.common import short_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE, CACHED = 120_000, 48
ROWS = 512
BPE, UNIGRAM = 2, 1
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def vocabulary(blob: bytes) -> dict:
    """What encoding needs of a model file: pieces, kinds, scores and the space rules.

    A unigram model's scores are used as they are. A BPE model's scores are negative ranks, which are
    no log-probabilities; each rank r among n pieces gets Zipf's, -log((r + 1) * (1 + 1/2 + ... 1/n)).
    """
    from sentencepiece import sentencepiece_model_pb2 as layout
    proto = layout.ModelProto()
    proto.ParseFromString(blob)
    spec = proto.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only models that leave the text as it is are supported")
    pieces, kinds = [p.piece for p in proto.pieces], [p.type for p in proto.pieces]
    scores = [p.score for p in proto.pieces]
    if proto.trainer_spec.model_type == BPE:
        ranks = sorted((-s, i) for i, s in enumerate(scores) if kinds[i] in (NORMAL, USER))
        whole = log(sum(1 / r for r in range(1, len(ranks) + 1)))
        for rank, (_, i) in enumerate(ranks):
            scores[i] = -log(rank + 1) - whole
    elif proto.trainer_spec.model_type != UNIGRAM:
        raise ValueError("only unigram and BPE models are supported")
    return {"pieces": pieces, "kinds": kinds, "scores": scores, "prefix": spec.add_dummy_prefix}


class Codec:
    """Encodes and decodes with one vocabulary.

    Inside, a space is a plain space and not the sign for it in pieces, so that Western texts stay
    strings of one byte a letter; ids wait in the cache as bytes.
    """

    def __init__(self, known: dict):
        self.pieces, self.prefix = known["pieces"], known["prefix"]
        self.ids, self.scores = {}, {}
        self.bytes_of: dict[int, int] = {}
        self.unknown = 0
        for i, (piece, kind, score) in enumerate(zip(known["pieces"], known["kinds"], known["scores"])):
            if kind in (NORMAL, USER) and piece:
                self.ids[piece], self.scores[piece] = i, score
            elif kind == BYTE:
                self.bytes_of[i] = int(piece[1:-1], 16)
            elif kind == UNKNOWN:
                self.unknown = i
        self.byte_ids = {b: i for i, b in self.bytes_of.items()} if len(self.bytes_of) == 256 else {}
        self.silent = {i for i, kind in enumerate(known["kinds"]) if kind == CONTROL}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown_score = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.kind = "H" if len(self.pieces) <= 1 << 16 else "I"
        # Pieces letter by letter: what may follow, the score (-inf if no piece ends here) and the ids.
        self.root: dict = {}
        for name, i in self.ids.items():
            piece, node = name.replace(SPACE, " "), self.root
            for c in piece[:-1]:
                node = node.setdefault(c, [{}, -inf, ()])[0]
            node.setdefault(piece[-1], [{}, -inf, ()])[1:] = [self.scores[name], (i,)]
        self.inner = {p[k:k + 2].replace(SPACE, " ") for p in self.ids for k in range(len(p) - 1)}
        # What a piece reads as; bytes of more than one to a character are put together first.
        self.surface = [p.replace(SPACE, " ") for p in self.pieces]
        self.high = np.zeros(len(self.pieces), bool)
        for i, b in self.bytes_of.items():
            self.surface[i] = chr(b)
            self.high[i] = b > 127
        for i in self.silent:
            self.surface[i] = ""
        # Where no piece can lie across a boundary, all paths meet there, whatever the text.
        self.split = re.compile(self._parts())
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _parts(self) -> str:
        inner = [p for p in self.ids if SPACE in p.lstrip(SPACE)]
        if inner:
            return r"[\s\S]+"
        alone = "".join(c for c in "\n\r\t" if not any(c in p and len(p) > 1 for p in self.ids))
        if not alone:
            return " *[^ ]+| +"
        return f" *[^ {alone}]+| +|[{alone}]"

    def spell(self, char: str) -> tuple[int, ...]:
        """Ids of a character without a piece of its own."""
        if self.byte_ids:
            return tuple(self.byte_ids[b] for b in char.encode("utf-8", "replace"))
        return (self.unknown,)

    def paths(self, text: str) -> Iterator[tuple[int, ...]]:
        """Ids of the best path of a text with plain spaces, in parts as they become certain.

        Keeps the boundaries since the last certain one. A boundary is certain once no piece of the
        text lies across it, or once the best paths to all boundaries that later pieces can still
        start from run through it. Ties go to the path whose last piece is longest.
        """
        root, longest = self.root, self.longest
        n, base, reach, check = len(text), 0, 0, 4 * longest
        best, back = [0.0] + [-inf] * longest, [(0, ())] * (longest + 1)
        for s in range(n):
            at = s - base
            here = best[at]
            if len(best) < at + longest + 1:
                best += [-inf] * longest
                back += [(0, ())] * longest
            first = root.get(text[s])
            if first is None or first[1] == -inf:
                if here + self.unknown_score > best[at + 1]:
                    best[at + 1], back[at + 1] = here + self.unknown_score, (at, self.spell(text[s]))
                reach = max(reach, s + 1)
            node = root
            for e in range(s, min(n, s + longest)):
                found = node.get(text[e])
                if found is None:
                    break
                node, score, ids = found
                if score > -inf:
                    reach = max(reach, e + 1)
                    if here + score > best[e + 1 - base]:
                        best[e + 1 - base], back[e + 1 - base] = here + score, (at, ids)
            if reach == s + 1:
                yield self._walk(back, at + 1)
                base = s + 1
                best, back = [0.0] + [-inf] * longest, [(0, ())] * (longest + 1)
                check = 4 * longest
            elif at + 1 >= check:
                meet = self._meeting(back, range(at + 1, reach - base + 1))
                if meet:
                    yield self._walk(back, meet)
                    back = [(b - meet, ids) for b, ids in back[meet:]]
                    best = [b - best[meet] for b in best[meet:]]
                    base += meet
                check = max(4 * longest, 2 * (s + 1 - base))

    def path(self, text: str) -> tuple[int, ...]:
        """Ids of the best path of a text so short that the window holds it all."""
        root, n = self.root, len(text)
        best, back = [0.0] + [-inf] * n, [(0, ())] * (n + 1)
        for s in range(n):
            here = best[s]
            node, e = root, s
            for c in text[s:]:
                found = node.get(c)
                if found is None:
                    break
                node, score, ids = found
                e += 1
                total = here + score
                if total > best[e]:
                    best[e], back[e] = total, (s, ids)
            first = root.get(text[s])
            if first is None or first[1] == -inf:
                total = here + self.unknown_score
                if total > best[s + 1]:
                    best[s + 1], back[s + 1] = total, (s, self.spell(text[s]))
        return self._walk(back, n)

    @staticmethod
    def _walk(back: list, end: int) -> tuple[int, ...]:
        parts = []
        while end:
            end, ids = back[end]
            parts.append(ids)
        parts.reverse()
        return tuple(chain.from_iterable(parts))

    @staticmethod
    def _meeting(back: list, ends) -> int:
        """The last boundary that the paths to all these ends share; 0 is the certain one."""
        shared = None
        for end in ends:
            if not back[end][1]:
                continue
            own, at = set(), end
            while at:
                own.add(at)
                at = back[at][0]
            shared = own if shared is None else shared & own
        return max(shared, default=0) if shared else 0

    def packed(self, ids) -> bytes:
        return array(self.kind, ids).tobytes()

    def segment(self, text: str) -> bytes:
        """Ids of a short segment: cut where no piece holds both neighbours, each part by its best path."""
        inner, cache, older = self.inner, self.cache, self.older
        cuts = [k for k in range(1, len(text)) if text[k - 1:k + 1] not in inner]
        if not cuts:
            return self.packed(self.path(text))
        out = b""
        for a, b in zip([0, *cuts], [*cuts, len(text)]):
            part = text[a:b]
            ids = cache.get(part) or older.get(part)
            if ids is None:
                ids = cache[part] = self.packed(self.path(part))
            out += ids
        return out

    def encode(self, text: str) -> array:
        """Ids of a whole text."""
        made = bytearray()
        for k, part in enumerate(text.split(SPACE) if text else ()):
            if k:
                # The sign that stands for a space, if the text itself holds it, is spelled in bytes.
                made += self.packed(self.spell(SPACE))
            body = " " + part if self.prefix and not k else part
            found = self.split.findall(body) if len(body) < 1 << 20 else (m.group(0) for m in self.split.finditer(body))
            get = self.cache.get
            for segment in found:
                ids = get(segment)
                if ids is None:
                    if len(segment) > CACHED:
                        for part_ids in self.paths(segment):
                            made += self.packed(part_ids)
                        continue
                    ids = self.older.get(segment) or self.segment(segment)
                    if len(self.cache) >= CACHE:
                        self.older, self.cache = self.cache, {}
                        get = self.cache.get
                    self.cache[segment] = ids
                made += ids
        out = array("i")
        out.frombytes(np.frombuffer(made, self.kind).astype(np.int32).tobytes())
        return out

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int32)
        if not self.high[ids].any():
            whole = "".join(map(self.surface.__getitem__, ids.tolist()))
        else:
            text, run = [], bytearray()
            for i in ids.tolist():
                if self.high[i]:
                    run.append(self.bytes_of[i])
                    continue
                if run:
                    text.append(run.decode("utf-8", "replace"))
                    run.clear()
                text.append(self.surface[i])
            whole = "".join([*text, run.decode("utf-8", "replace")])
        return whole[1:] if self.prefix and whole.startswith(" ") else whole


def load(path: str = MODEL) -> dict:
    """The vocabulary of a model file on the driver; it goes to the tasks by broadcast."""
    with open(path, "rb") as f:
        return vocabulary(f.read())


def _mapped(df: DataFrame, known: dict, source: str, added: str, function) -> DataFrame:
    """`df` with columns added by `function(codec, values of source)`, a few rows at a time."""
    names = [f.strip().split()[0] for f in added.split(",")]
    if source in names:
        raise ValueError(f"the column {source} would be replaced by what is made from it")
    own = df.drop(*names)
    shared = df.sparkSession.sparkContext.broadcast(known)
    held: list[Codec] = []

    def run(batches):
        if not held:
            held.append(Codec(shared.value))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                made = function(held[0], batch.column(batch.schema.get_field_index(source)))
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *names])

    schema = ", ".join([f"`{c}` {t}" for c, t in own.dtypes] + [added])
    return short_batches(own).mapInArrow(run, schema)


def _lists(rows: list[array]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate([np.frombuffer(r, np.int32) for r in rows if len(r)] or [np.zeros(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, known: dict | None = None, text="text") -> DataFrame:
    """`docs` with token_ids (array<int>), n_tokens and round_trip added.

    Ids are the best-scoring segmentation of the whole text. A NULL text counts as empty; an empty
    text has no ids. Characters without a piece are spelled in bytes where the model has them, so
    `round_trip` (decoding gives the text again) is then always true. Columns of these names are
    replaced, all other columns, repeated rows and NULL ids stay; an empty table gives an empty result.
    """
    def made(codec, column):
        texts = [t or "" for t in column.to_pylist()]
        rows = [codec.encode(t) for t in texts]
        return [_lists(rows), pa.array([len(r) for r in rows], pa.int64()),
                pa.array([codec.decode(r) == t for r, t in zip(rows, texts)])]

    source = docs.withColumn(text, F.col(text).cast("string"))
    return _mapped(source, known or load(), text, "token_ids array<int>, n_tokens long, round_trip boolean", made)


def decode(rows: DataFrame, known: dict | None = None, ids="token_ids") -> DataFrame:
    """`rows` with `decoded` added; NULL ids give NULL."""
    def made(codec, column):
        return [pa.array([None if r is None else codec.decode(r) for r in column.to_pylist()], pa.string())]

    return _mapped(rows, known or load(), ids, "decoded string", made)
