"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding.

A merge-type model joins, again and again, the adjacent pair whose union has
the best score.  The result is the one sequence of pieces that covers the text
and in which every two neighbours are what merging their union alone gives.
The encoder finds it without merging the text:

* an Aho-Corasick automaton gives the longest piece that starts at each place,
* a piece is taken if re-merging it with the piece before it gives the two
  back (remembered for each pair); else its longest shorter prefix is tried,
* where none fits, the place is marked in a bitfield as failed and the piece
  before it is shortened instead.  A failed place is never tried again, so
  the work is linear in the length.

The model file is read with the sentencepiece library (vocabulary, scores and
normalisation); encoding and decoding are done here.
"""

from __future__ import annotations

import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_text, worker_state

SPACE = "▁"
CACHE_ENTRIES = 700_000
FIT_ENTRIES = 300_000
CACHE_LENGTH = 48


class PieceModel:
    """Encoder and decoder of one merge-type model (its serialised bytes)."""

    def __init__(self, proto: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.sp = sp
        n = len(sp)
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unk, self.eos = sp.unk_id(), sp.eos_id()
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        special = {i for i in range(n) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.chars = {p for p in self.ids if len(p) == 1}
        self.identity = sp.normalize("é Ａ  b́ ") == f"{SPACE}é{SPACE}Ａ{SPACE}{SPACE}b́{SPACE}"
        self.split = self._splitter()
        whole = [p for p in self.ids if len(p) == 1 or self._merge(p) == [p]]
        self.automaton = ahocorasick.Automaton()
        for p in whole:
            self.automaton.add_word(p, (p, len(p) - 1))
        self.automaton.make_automaton()
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in whole_set), None)
                        for whole_set in [set(whole)] for p in whole}
        self._pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self._fit: dict[tuple[str, str], bool] = {}
        self._known = _Known(lambda part: array("i", self._encode_part(part)).tobytes(), CACHE_ENTRIES)
        self.words = _Known(self._word, CACHE_ENTRIES) if self.identity and self.split else None
        self.end = array("i", [self.eos]).tobytes()
        # An ASCII byte piece is a character of its own: it decodes like text (kind 4).
        self.plain = [p.replace(SPACE, " ") for p in self.pieces]
        for b, i in self.byte_ids.items():
            self.plain[i] = chr(b) if b < 128 else ""
        self.kind = np.array([4 if sp.is_byte(i) and self.plain[i] else 1 if sp.is_byte(i) else
                              2 if sp.is_control(i) else 3 if sp.is_unknown(i) else 0
                              for i in range(n)], np.int8)
        prefix = sp.normalize("a")
        self.dummy_prefix = prefix.startswith(SPACE)
        # what decode([unk]) shows for unknown pieces
        self.unk_surface = sp.decode([self.unk]) if self.unk >= 0 else ""

    def _splitter(self) -> re.Pattern | None:
        """Pattern of the stretches between borders that no piece goes over, None if there is none.

        Borders lie before a space symbol, around a line feed, and before an
        ASCII digit or mark that follows another character, but for the
        characters after which the vocabulary has such a mark.
        """
        inner = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(b == SPACE and a != SPACE for a, b in inner):
            return None
        marks = {chr(c) for c in range(33, 127) if not chr(c).isalpha()}
        bound = sorted({a for a, b in inner if b in marks and a not in marks and a != SPACE})
        if "\n" in self.chars:
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        m = r"!-@\[-`{-~"
        on = f"(?:(?<=[{re.escape(''.join(bound))}])[{m}]+)?" if bound else ""
        return re.compile(f"{SPACE}*[{m}]*(?:[^{SPACE}\n{m}]+{on})+|{SPACE}*[{m}]+|{SPACE}+|\n")

    def _merge(self, text: str) -> list[str]:
        """Merging from single characters, best score first, leftmost among equals (short texts only)."""
        parts, score, none = list(text), self.score.get, float("-inf")
        won = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while won:
            best = max(won)
            if best == none:
                break
            i = won.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del won[i]
            if i:
                won[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(won):
                won[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def fits(self, a: str, b: str) -> bool:
        """Whether merging a + b alone gives a, b back (remembered)."""
        if len(self._fit) >= FIT_ENTRIES:
            self._fit.clear()
        # where no piece has the two characters at the border, nothing merges over it
        got = self._fit[a, b] = a[-1] + b[0] not in self._pairs or self._merge(a + b) == [a, b]
        return got

    def backtrack(self, text: str) -> list[str]:
        """Pieces of a text that consists of known characters."""
        n = len(text)
        longest: list[str | None] = [None] * n
        for end, (p, k) in self.automaton.iter(text):
            longest[end - k] = p  # of two that start here, the later one to end is longer
        known, fits, shorter = self._fit.get, self.fits, self.shorter
        open_at = bytearray(b"\xff") * (n // 8 + 1)  # a cleared bit: no way on from this place
        out: list[str] = []
        at, p = 0, longest[0]
        while at < n:
            while p is not None:
                end = at + len(p)
                if open_at[end >> 3] >> (end & 7) & 1:
                    if not out:
                        break
                    ok = known((out[-1], p))
                    if ok or ok is None and fits(out[-1], p):
                        break
                p = shorter[p]
            if p is not None:
                out.append(p)
                at += len(p)
                p = longest[at] if at < n else None
                continue
            open_at[at >> 3] &= ~(1 << (at & 7)) & 255
            if not out:
                raise ValueError(f"no encoding of {text[:40]!r}")
            p = out.pop()
            at -= len(p)
            p = shorter[p]
        return out

    def _encode_part(self, part: str) -> list[int]:
        """Ids of one stretch; a character without a piece stands alone (as bytes, or unknown)."""
        if self.chars.issuperset(part):
            return list(map(self.ids.__getitem__, self.backtrack(part)))
        out: list[int] = []
        lo = 0
        for hi, c in enumerate(part):
            if c not in self.chars:
                if lo < hi:
                    out += map(self.ids.__getitem__, self.backtrack(part[lo:hi]))
                out += [self.byte_ids[b] for b in c.encode()] if self.byte_ids else [self.unk]
                lo = hi + 1
        if lo < len(part):
            out += map(self.ids.__getitem__, self.backtrack(part[lo:]))
        return out

    def encode_packed(self, text: str | None, add_eos: bool = True) -> bytes:
        """Ids as native 32-bit numbers."""
        text = text or ""
        plain = text and text[0] != " " and text[-1] != " " and "  " not in text and SPACE not in text
        if plain and self.words and self.dummy_prefix:
            packed = b"".join(map(self.words.__getitem__, text.split(" ")))
            return packed + self.end if add_eos else packed
        if self.identity:
            norm = (SPACE if self.dummy_prefix and text else "") + text.replace(" ", SPACE)
        else:
            norm = self.sp.normalize(text)
        packed = b"".join(map(self._known.__getitem__, self._stretches(norm)))
        return packed + self.end if add_eos else packed

    def _stretches(self, norm: str) -> list[str]:
        return self.split.findall(norm) if self.split else [norm] if norm else []

    def _word(self, word: str) -> bytes:
        """Packed ids of a word with the space symbol before it."""
        if word.isalpha():  # one stretch
            return self._known[SPACE + word]
        return b"".join(map(self._known.__getitem__, self._stretches(SPACE + word)))

    def encode(self, text: str | None, add_eos: bool = True) -> list[int]:
        return memoryview(self.encode_packed(text, add_eos)).cast("i").tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of a sequence of ids: control pieces are silent, byte pieces are joined as UTF-8."""
        at = np.asarray(ids, np.int32)
        kinds = self.kind[at]
        if len(at) and kinds[-1] == 2:
            at, kinds = at[:-1], kinds[:-1]
        if not len(at):
            return ""
        if kinds[0] == 0 and not (kinds & 3).any():
            text = "".join(map(self.plain.__getitem__, at.tolist()))
            return text[1:] if self.dummy_prefix and text.startswith(" ") else text
        out: list[str] = []
        run = bytearray()
        begin = True  # nothing but silent pieces so far
        for i, kind in zip(at.tolist(), kinds.tolist()):
            if kind in (1, 4):
                run.append(int(self.pieces[i][3:5], 16))
                continue
            if run:
                out.append(_utf8(run))
                run = bytearray()
                begin = False
            if kind == 2:
                continue
            piece = self.unk_surface if kind == 3 else self.plain[i]
            if begin and self.dummy_prefix and kind == 0 and piece.startswith(" "):
                piece = piece[1:]
                begin = False
            out.append(piece)
            begin = begin and not piece
        if run:
            out.append(_utf8(run))
        return "".join(out)


class _Known(dict):
    """Packed ids of what was met lately: ``most`` entries, in a young and an old half."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.old = encode, most, {}

    def __bool__(self) -> bool:
        return True

    def __missing__(self, part: str) -> bytes:
        packed = self.old.get(part)
        if packed is None:
            packed = self.encode(part)
        if len(part) <= CACHE_LENGTH:
            if len(self) >= self.most // 2:
                self.old = dict(self)
                self.clear()
            self[part] = packed
        return packed


def _utf8(raw: bytes) -> str:
    """UTF-8 text; every byte that is part of no character is one U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for k in (1, 2, 3, 4):
                try:
                    out.append(bytes(raw[at:at + k]).decode())
                    at += k
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def load_model(proto: bytes) -> PieceModel:
    """The model, kept with what it has met between the tasks of one Python worker."""
    return worker_state("pieces", proto, lambda: PieceModel(proto))


def encode_texts(df: DataFrame, model_path: str, text_col: str = "text", add_eos: bool = True) -> DataFrame:
    """``df`` with ids (array<int>) and decoded (what the ids decode to).

    Null texts are encoded like empty ones (the end id only, if asked for).
    Every text is encoded whole, whatever its length.  The model file is read
    on the driver and broadcast (its size does not depend on the data).
    Columns named like a result column are replaced.
    """
    with open(model_path, "rb") as f:
        proto = df.sparkSession.sparkContext.broadcast(f.read())

    def start():
        model = load_model(proto.value)

        def work(texts):
            packed = [model.encode_packed(t, add_eos) for t in texts]
            ids = [np.frombuffer(p, np.int32) for p in packed]
            ends = [0]
            for p in packed:
                ends.append(ends[-1] + len(p) // 4)
            values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(packed))])
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
                    [model.decode(i) for i in ids]]
        return work

    return map_text(df, text_col, [T.StructField("ids", T.ArrayType(T.IntegerType())),
                                   T.StructField("decoded", T.StringType())], start)
