"""Token ids of whole texts by the tokenizers library, each distinct run of characters encoded once."""

from __future__ import annotations

import functools
import json
import re
import string
from collections.abc import Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from latticework.llm.text import LONGEST, parts, release

# Runs of characters, as the tokenizer splits a text, and chunks of other characters that a Python worker remembers.
RUNS, CHUNKS = 400_000, 50_000
# Bytes of ids from which it forgets runs, however few.
IDS_BYTES = 64 << 20
# New chunks that one call of the library encodes, new runs, and bytes of plain text that are split together.
AT_ONCE, RUNS_AT_ONCE, PLAIN_BYTES = 200, 1_000, 4 << 20

# The pattern by which lower-casing byte-level word tokenizers split a text into runs, and how such
# tokenizers write bytes, visible ones as themselves and the others from 256 on.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_WRITTEN = np.arange(256, dtype="<u4")
_WRITTEN[[b for b in range(256) if b not in _VISIBLE]] = np.arange(256, 512 - len(_VISIBLE))
_WRITTEN[ord("\n")] = ord("\n")

# A chunk between white space that has a character that is neither ASCII white space nor plain.
_OTHER_CHUNK = re.compile(r"(?<![^\x09-\x0D ])([!-~À-ÖØ-öø-ÿ]*+[^\x09-\x0D ]+)")
_SPACES = re.compile(r"[\x09-\x0D ]+")

# The bytes of plain text, letters of Latin-1 being 0xC3 and one more, and each of them in lower case.
_PLAIN = bytes({*range(0x09, 0x0E), *range(0x20, 0x7F), 0xC3, *range(0x80, 0xC0)} - {0x97, 0xB7})
_UPPER = bytes({*range(ord("A"), ord("Z") + 1), *range(0x80, 0x9F)} - {0x97})
_LOWER = bytes.maketrans(_UPPER, bytes(b + 0x20 for b in _UPPER))

# Kinds of bytes of plain text in lower case; visible letters of Latin-1 are a byte of 0xC3 and one from 0x80 on.
_GAP, _LETTER, _DIGIT, _SIGN = range(4)
_KIND = np.full(256, _SIGN, np.int8)
_GAPS = b" \t\n\x0b\x0c\r"
_KIND[list(_GAPS)] = _GAP
_KIND[[*range(ord("a"), ord("z") + 1), *range(0x80, 256)]] = _LETTER
_KIND[list(b"0123456789")] = _DIGIT


def run_starts(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes of plain text in lower case start a run, and which are in one; ``raw`` ends with three gaps."""
    kind = _KIND[raw]
    inside = kind != _GAP
    new = np.append(True, kind[1:] != kind[:-1])
    new |= kind == _DIGIT
    # An apostrophe that starts a run, before the letters of a short form, takes these along.
    quote = np.flatnonzero((raw == ord("'")) & new)
    quote = quote[new[quote + 1] & (kind[quote + 1] == _LETTER)]
    one, two = raw[quote + 1], raw[quote + 2]
    short = np.isin(one, list(b"stmd"))
    long = np.isin(one, list(b"rv")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    new[quote[short | long] + 1] = False
    new[quote[short] + 2] = True
    new[quote[long] + 3] = True
    return new & inside, inside


def binary(values: np.ndarray, borders: np.ndarray) -> pa.LargeBinaryArray:
    """The bytes of ``values`` between each two ``borders``."""
    buffers = [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(values)]
    return pa.Array.from_buffers(pa.large_binary(), len(borders) - 1, buffers)


class Encoder:
    """Little-endian unsigned 32-bit ids of texts, equal to ``Tokenizer.encode`` of the whole text.

    For tokenizers that drop white space: it ends every token, so a text may be encoded chunk by chunk
    between ASCII white space. Strings of special tokens have no white space either. Plain characters, which
    the tokenizer's normalizer leaves as they are but for case, are split into runs by its own pattern, a long stretch of
    the text at once, and the library's model encodes each distinct run once. Chunks of other characters are
    encoded by the library, new ones of a part of the text together.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        for one, two in (("a", "b"), ("it's", "'s ."), ("1", "2"), ("é", "́a")):
            if self._ids(f"{one} \n{two}") != self._ids(one) + self._ids(two):
                raise ValueError(f"{path}: white space is part of this tokenizer's tokens")
        # The model alone, for runs between white space.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        # Where the ids of a run are, how many stretches of text had it, and the ids.
        self.runs: dict[bytes, int] = {}
        self.uses = np.empty(0, np.int32)
        self.ids = binary(np.empty(0, "<u4"), np.zeros(1, np.int64))
        self.chunks: dict[str, bytes] = {}
        steps = json.loads(self.tokenizer.to_str())
        kinds = [step["type"] for step in (steps["normalizer"] or {}).get("normalizers", [])]
        splits = [step.get("pattern") for step in (steps["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.plain = kinds == ["NFC", "Replace", "Lowercase"] and splits == [{"Regex": _SPLIT}, None]
        # Case matters to strings of special tokens; elsewhere a lower-casing tokenizer makes one of many chunks.
        self.special = [str(t).lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lower = self._ids(string.ascii_uppercase) == self._ids(string.ascii_lowercase)
        del steps
        release()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _look_up(self, runs: list[bytes]) -> np.ndarray:
        """The places of distinct runs in ``self.ids``; the model encodes many new ones in one call."""
        known, size, encoded = self.runs, len(self.ids), [self.ids]
        found = np.fromiter(map(known.get, runs, repeat(-1)), np.int64, len(runs))
        at = np.flatnonzero(found < 0)
        found[at] = np.arange(size, size + len(at))
        new = [runs[n] for n in at.tolist()]
        for first in range(0, len(new), RUNS_AT_ONCE):
            some = new[first : first + RUNS_AT_ONCE]
            written = _WRITTEN[np.frombuffer(b"\n".join(some), np.uint8)].tobytes().decode("utf-32-le")
            one = self.model.encode(written, add_special_tokens=False)
            counts = np.bincount(np.array(one.word_ids, np.int64), minlength=len(some))
            encoded.append(binary(np.array(one.ids, "<u4"), 4 * np.append(0, np.cumsum(counts))))
        kept = np.flatnonzero(np.fromiter(map(len, new), np.int64, len(new)) <= LONGEST)[: RUNS - len(known)]
        known.update(zip(map(new.__getitem__, kept.tolist()), (size + kept).tolist()))
        self.ids = pa.concat_arrays(encoded)
        self.uses = np.append(self.uses, np.zeros(len(new), np.int32))
        self.uses[found] += 1
        return found

    def _forget(self) -> None:
        """Remember half as much, the runs used most; their uses count half from now on."""
        runs, at = list(self.runs), np.fromiter(self.runs.values(), np.int64, len(self.runs))
        most = np.argsort(-self.uses[at], kind="stable")[: RUNS // 2]
        sizes = np.asarray(pc.binary_length(self.ids))[at[most]]
        most = most[np.cumsum(sizes) <= IDS_BYTES // 2]
        self.runs = {runs[n]: place for place, n in enumerate(most.tolist())}
        self.ids, self.uses = self.ids.take(pa.array(at[most])), self.uses[at[most]] // 2

    def _plain(self, pieces: list[bytes]) -> list[memoryview]:
        """The ids of each piece of plain text in lower case, all split and looked up together."""
        if not pieces:
            return []
        joined = b"\n".join([*pieces, b"\n\n"])
        starts, inside = run_starts(np.frombuffer(joined, np.uint8))
        # A gap has no ids, so what is looked up has none.
        text, firsts = joined.translate(None, _GAPS), np.flatnonzero(starts[inside])
        borders = pa.array(np.append(firsts, len(text)), pa.int32()).buffers()[1]
        runs = pa.Array.from_buffers(pa.binary(), len(firsts), [None, borders, pa.py_buffer(text)]).dictionary_encode()
        _, cuts, kept = runs.dictionary.buffers()
        cuts, kept = np.frombuffer(cuts, np.int32)[: len(runs.dictionary) + 1].tolist(), kept.to_pybytes() if kept else b""
        distinct = [kept[a:b] for a, b in zip(cuts, cuts[1:])]
        at = self._look_up(distinct)[np.asarray(runs.indices)]
        found = self.ids.take(pa.array(at))
        if len(self.ids) > RUNS or self.ids.nbytes > IDS_BYTES:
            self._forget()
        _, upto, ids = found.buffers()
        ends = np.cumsum([len(piece) + 1 for piece in pieces])
        cuts = np.searchsorted(np.flatnonzero(starts), np.append(0, ends))
        cuts = np.frombuffer(upto, np.int64)[cuts].tolist()
        ids = memoryview(ids or b"")
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk, by the library."""
        known = self.chunks
        new = list(dict.fromkeys(chunk for chunk in chunks if chunk not in known))
        found = {}
        for at in range(0, len(new), AT_ONCE):
            some = new[at : at + AT_ONCE]
            encoded = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids, of = np.array(encoded.ids, "<u4"), np.array(encoded.word_ids, np.int64)
            borders = np.searchsorted(of, np.arange(len(some) + 1)).tolist()
            found.update((c, ids[a:b].tobytes()) for c, a, b in zip(some, borders, borders[1:]))
        out = [known[chunk] if chunk in known else found[chunk] for chunk in chunks]
        if len(known) + len(found) > CHUNKS:
            known.clear()
        known.update((chunk, ids) for chunk, ids in found.items() if len(chunk) <= LONGEST)
        return out

    def _pieces(self, part: bytes) -> list[tuple[bool, bytes]]:
        """A part of a text as plain pieces in lower case (true) and the ids of what is between them."""
        if self.plain and b"<|" not in part and not part.translate(None, _PLAIN):
            part.decode()  # other bytes than text are an error here too
            return [(True, part.translate(_LOWER))]
        low = part.lower()
        if self.lower and not any(special in low for special in self.special):
            part = low
        text = part.decode()
        if not self.plain or "<|" in text:
            return [(False, ids) for ids in self._chunks([chunk for chunk in _SPACES.split(text) if chunk])]
        # Plain stretches and other chunks take turns.
        pieces = _OTHER_CHUNK.split(text)
        found = [(True, piece.lower().encode()) for piece in pieces]
        found[1::2] = [(False, ids) for ids in self._chunks(pieces[1::2])]
        return found

    def encode_all(self, texts: Sequence[bytes | None]) -> list[bytes]:
        """The ids of each text; a null or empty text has none."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[list[bytes], int, bytes]] = []

        def settle():
            for (ids, at, _), found in zip(waiting, self._plain([piece for *_, piece in waiting])):
                ids[at] = found
            waiting.clear()

        held = 0
        for ids, data in zip(out, texts):
            for part in parts(data or b""):
                for plain, piece in self._pieces(part):
                    if plain:
                        waiting.append((ids, len(ids), piece))
                        held += len(piece)
                    ids.append(piece)
                if held >= PLAIN_BYTES:
                    settle()
                    held = 0
        settle()
        found = [b"".join(ids) for ids in out]
        del out
        # What a call of the library takes is many times its text.
        release()
        return found

    def encode(self, data: bytes | None) -> bytes:
        return self.encode_all([data])[0]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker and vocabulary."""
    return Encoder(path)
