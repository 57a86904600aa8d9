"""SentencePiece encoding and decoding by a prefix table of last tokens.

In a byte-pair vocabulary every prefix of a text has exactly one encoding, hence one last token. The
table stores that token for each prefix: automaton matches ending at a position are the candidates,
and a candidate stands if the prefix before it is encoded with a last token it may follow. Ids are
read off backwards from the end. A pair may stand side by side if undoing the merges on both sides
never shows two parts that would have been merged first.

Texts are cut before each run of the space mark (no piece holds a mark after another character), so
table and ids of a word can be kept and used again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import out_schema, with_text

MARK = "▁"
# Words whose ids a worker remembers, in two generations.
REMEMBERED = 400_000


class PieceCodec:
    """Encoder and decoder of one model file, with the end id and without sampling."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.end = model.eos_id()
        self.unknown = model.unk_id()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.special = special
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        text = [i for i in range(size) if i not in special and i not in self.byte_of]
        self.runs = {len(self.pieces[i]): i for i in text if set(self.pieces[i]) == {MARK}}
        # Merge order: single characters come first, then pieces by falling score.
        words = [i for i in text if len(self.pieces[i]) == 1 or set(self.pieces[i]) != {MARK}]
        words.sort(key=lambda i: (len(self.pieces[i]) > 1, -model.get_score(i), i))
        self.rank_id = words
        self.alphabet = frozenset(self.pieces[i] for i in words if len(self.pieces[i]) == 1)
        self.chars = len(self.alphabet)
        self.left, self.right = list(range(len(words))), list(range(len(words)))
        self.merged: dict[tuple[int, int], int] = {}
        self.allowed: dict[int, bool] = {}
        known = {self.pieces[i]: rank for rank, i in enumerate(words)}
        for rank in range(self.chars, len(words)):
            piece = self.pieces[words[rank]]
            for cut in range(1, len(piece)):
                first, second = known.get(piece[:cut], rank), known.get(piece[cut:], rank)
                if first < rank and second < rank and self.may_follow(first, second):
                    self.left[rank], self.right[rank] = first, second
                    self.merged[first, second] = rank
                    break
        # Pieces that no order of merges reaches are never made.
        automaton = ahocorasick.Automaton()
        for rank, i in enumerate(words):
            if rank < self.chars or self.left[rank] != rank:
                automaton.add_word(self.pieces[i], (len(self.pieces[i]), rank))
        automaton.make_automaton()
        self.automaton = automaton
        self.allowed.clear()
        self.numbers = [b"%d" % i for i in range(size)]
        self.plain = [self._bytes(i) for i in range(size)]
        self.new: dict[str, tuple[int, bytes, bytes]] = {}
        self.old: dict[str, tuple[int, bytes, bytes]] = {}

    def may_follow(self, first: int, second: int) -> bool:
        """Whether two tokens stay apart: merges are undone, the later one first, down to characters."""
        bound = len(self.rank_id)
        while True:
            if self.merged.get((first, second), bound) < bound:
                return False
            # Of equal tokens the left one was made first, so the right one is undone first.
            if first > second and self.left[first] != first:
                bound, first = first, self.right[first]
            elif self.left[second] != second:
                bound, second = second + 1, self.left[second]
            elif self.left[first] != first:
                bound, first = first, self.right[first]
            else:
                return True

    def _part_ids(self, part: str) -> list[int]:
        """Ids of a word in which all characters are pieces, by the table of last tokens."""
        size = len(part)
        lengths, ranks = [0] * (size + 1), [-1] * (size + 1)
        allowed = self.allowed
        for at, (length, rank) in self.automaton.iter(part):
            end = at + 1
            if ranks[end] >= 0:
                continue
            start = end - length
            if start:
                before = ranks[start]
                if before < 0:
                    continue
                stands = allowed.get(before << 20 | rank)
                if stands is None:
                    stands = allowed[before << 20 | rank] = self.may_follow(before, rank)
                if not stands:
                    continue
            lengths[end], ranks[end] = length, rank
        ids, end = [], size
        while end:
            ids.append(self.rank_id[ranks[end]])
            end -= lengths[end]
        ids.reverse()
        if len(allowed) > 500_000:
            allowed.clear()
        return ids

    def word_ids(self, word: str) -> list[int]:
        """Ids of a run of space marks followed by other characters; either part may be missing."""
        rest = word.lstrip(MARK)
        marks = len(word) - len(rest)
        if marks and rest:
            marks, rest = marks - 1, MARK + rest
        if self.alphabet.issuperset(rest):
            ids = self._part_ids(rest)
        else:
            ids, held = [], 0
            for at, char in enumerate(rest):
                if char not in self.alphabet:
                    ids += self._part_ids(rest[held:at])
                    ids += [self.byte_ids[b] for b in char.encode()]
                    held = at + 1
            ids += self._part_ids(rest[held:])
        if not marks:
            return ids
        # Runs of marks merge last, from the left; a mark that joined no word belongs to the run.
        if rest and marks and ids[0] == self.runs[1]:
            marks += 1
            del ids[0]
        run: list[int] = []
        for _ in range(marks):
            run.append(1)
            while len(run) > 1 and run[-2] + run[-1] in self.runs:
                run[-2:] = [run[-2] + run[-1]]
        return [self.runs[length] for length in run] + ids

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces with marks as spaces, bytes joined to characters, without the leading space."""
        out: list[str] = []
        for of_bytes, group in groupby(ids, self.byte_of.__contains__):
            joined = b"".join(map(self.plain.__getitem__, group))
            out.append(_joined(joined) if of_bytes else joined.decode())
        text = "".join(out)
        first = next((i for i in ids if i not in self.special), None)
        return text[1:] if first is not None and self.pieces[first].startswith(MARK) else text

    def _bytes(self, i: int) -> bytes:
        if i in self.byte_of:
            return bytes([self.byte_of[i]])
        if i in self.special:
            return b""
        return self.pieces[i].replace(MARK, " ").encode()

    def _entry(self, word: str) -> tuple[int, bytes, bytes]:
        """Count, ids as text and decoded bytes of a word."""
        found = self.old.get(word)
        if found is None:
            ids = self.word_ids(word)
            found = (len(ids), b" ".join([self.numbers[i] for i in ids]), b"".join([self.plain[i] for i in ids]))
        if len(word) <= 64:
            if len(self.new) >= REMEMBERED:
                self.old, self.new = self.new, {}
            self.new[word] = found
        return found

    def cut(self, text: str) -> list[str]:
        """The text with its leading mark, before each run of marks."""
        marked = MARK + text.replace(" ", MARK)
        if MARK * 2 not in marked:
            return [MARK + word for word in marked[1:].split(MARK)]
        parts, word = [], ""
        for piece in marked[1:].split(MARK):
            word += MARK
            if piece:
                parts.append(word + piece)
                word = ""
        return parts + [word] if word else parts

    def encode(self, text: str | None) -> list[int]:
        """All ids of a text with the end id; NULL and '' give the end id only."""
        ids = [i for word in self.cut(text) for i in self.word_ids(word)] if text else []
        return ids + [self.end]

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids as text, SHA-256 of the decoded text."""
        if not text:
            return 1, hashlib.sha256(b"%d" % self.end).hexdigest(), hashlib.sha256(b"").hexdigest()
        entries = []
        for word in self.cut(text):
            entries.append(self.new.get(word) or self._entry(word))
        counts, ids, decoded = zip(*entries)
        out = b"".join(decoded)
        return (
            sum(counts) + 1,
            hashlib.sha256(b" ".join(ids) + b" %d" % self.end).hexdigest(),
            hashlib.sha256(_joined(out[1:] if out[:1] == b" " else out).encode()).hexdigest(),
        )


def _joined(data: bytes) -> str:
    """Decoded text; bytes that form no character become U+FFFD one by one."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as wrong:
            out.append(data[at : at + wrong.start].decode() + "�")
            at += wrong.start + 1
    return "".join(out)


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The codec of a model file, built once per Python worker."""
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def token_digests(df: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` with n_tokens, ids_sha256 and decoded_sha256; one row out for each row in.

    NULL texts count as empty: one id, the end. Columns of `keep` with one of the three names are
    replaced. The model file must be at `path` on every executor.
    """
    added = ("n_tokens", "ids_sha256", "decoded_sha256")
    keep = [c for c in keep if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = codec(path).digest
        for batch in batches:
            rows = [digest(t) for t in batch.column(batch.schema.names.index(text)).to_pylist()]
            counts, ids, decoded = zip(*rows) if rows else ((), (), ())
            arrays = [*batch.columns[: len(keep)], pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *added])

    return df.select(*with_text(keep, text)).mapInArrow(run, out_schema(df, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string"))


def encode_documents(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of every row's text as an array column; a column of that name is replaced."""
    @F.pandas_udf("array<int>")
    def encode(texts):
        own = codec(path)
        return texts.map(own.encode)

    return df.withColumn(ids, encode(text))


def decode_documents(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of an id column; NULL ids give NULL."""
    @F.pandas_udf("string")
    def decode(values):
        own = codec(path)
        return values.map(lambda v: None if v is None else own.decode([int(i) for i in v]))

    return df.withColumn(text, decode(ids))
