"""Token ids of Arrow text columns with a public byte-level BPE vocabulary.

The vocabulary's splitting pattern never matches across the end of a run of
non-space characters, nor from a letter or digit into a mark, so a text may be cut before
any white space that follows a non-space character and before a mark that follows an
ASCII letter or digit, and the pieces encoded on their own give the ids of the whole.
Each distinct piece of a batch is encoded once by the ``tokenizers`` library; a worker
remembers pieces it has met. Texts with white space beyond ASCII stay uncut.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space beyond ASCII that the pattern's \s also matches (fixed values).
WIDE_SPACE = "[\u0085   -     　]"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True

_MARK = np.zeros(256, bool)  # no apostrophe: it may begin a letter pattern
_MARK[list(b'!"#$%&()*+,-./:;<=>?@[]^_{|}~')] = True

_DOUBLE = {a + b for a in (b" ", b"\n") for b in (b" ", b"\n", b"\t", b"\x0b", b"\x0c", b"\r")}

_WORKER: dict = {}
_REMEMBER = 500_000  # pieces a worker keeps, about 200 bytes each


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """``encode(texts)`` gives flat uint32 ids and each text's offsets in them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.newline = self.library.token_to_id("Ċ")
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def of(path: str) -> "Encoder":
        if path not in _WORKER:
            _WORKER[path] = Encoder(path)
        return _WORKER[path]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, first = self._pieces(texts)
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self.known
        ids = list(map(known.get, distinct))
        fresh = [i for i, x in enumerate(ids) if x is None]
        found = self._encode([distinct[i] for i in fresh])
        for i, x in zip(fresh, found):
            ids[i] = x
        if len(known) < _REMEMBER:
            known.update((distinct[i], ids[i]) for i in fresh[: _REMEMBER - len(known)])
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        begin = np.cumsum(sizes, dtype=np.int32) - sizes
        table = np.frombuffer(b"".join(ids), np.uint32)
        which = coded.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[which]
        ends = np.cumsum(lengths, dtype=np.int64)
        at = np.ones(int(ends[-1]), np.int32)  # runs of consecutive places in the table, as differences
        begins = begin[which]
        at[0] = begins[0]
        at[ends[:-1]] = begins[1:] - (begins[:-1] + lengths[:-1] - 1)
        return table[np.cumsum(at, dtype=np.int32)], np.concatenate([[0], ends])[first]

    @staticmethod
    def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of all texts, and the first piece of each text (one more at the end)."""
        texts = texts.cast(pa.large_string())
        _, offs, data = texts.buffers()
        offsets = np.frombuffer(offs, np.int64)[texts.offset: texts.offset + len(texts) + 1]
        base = int(offsets[0])
        raw = np.frombuffer(data, np.uint8)[base: int(offsets[-1])] if data else np.zeros(0, np.uint8)
        offsets = offsets - base
        space = _SPACE[raw]
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[1:] |= _MARK[raw[1:]] & _WORD[raw[:-1]]
        wide = pc.match_substring_regex(texts, WIDE_SPACE)
        for i in np.flatnonzero(np.asarray(pc.fill_null(wide, False))):
            cut[offsets[i]: offsets[i + 1]] = False
        cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts, len(raw)).astype(np.int64)
        if not len(starts):
            return pa.array([], pa.large_binary()), np.zeros(len(texts) + 1, np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts),
                                                  [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        return pieces, np.searchsorted(starts, offsets)

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32) of each piece. Pieces without white space after
        their first character are encoded together, parted by line ends, which stay
        tokens of their own there."""
        out: list[bytes] = [b""] * len(pieces)
        joint, single = [], []
        for i, x in enumerate(pieces):
            # white space in first place only, and no other than a space or a line end
            plain = x[0] not in b"\t\x0b\x0c\r" and x[-1] not in b" \n\t\x0b\x0c\r"
            (joint if plain and len(x.split(None, 1)) == 1 and x[:2] not in _DOUBLE else single).append((i, x))
        mark = np.uint32(self.newline).tobytes()
        for k in range(0, len(joint), 4096):
            part = joint[k: k + 4096]
            text = b"\n".join(x[1:] if x[:1] == b"\n" else x for _, x in part).decode()
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            marks = np.flatnonzero(ids == self.newline)
            if len(marks) != len(part) - 1:
                single += part
                continue
            raw, ends = ids.tobytes(), np.append(marks, len(ids)) * 4
            a = 0
            for (i, x), b in zip(part, ends.tolist()):
                out[i] = mark + raw[a:b] if x[:1] == b"\n" else raw[a:b]
                a = b + 4
        for k in range(0, len(single), 1024):
            part = single[k: k + 1024]
            coded = self.library.encode_batch_fast([x.decode() for _, x in part], add_special_tokens=False)
            for (i, _), e in zip(part, coded):
                out[i] = np.array(e.ids, np.uint32).tobytes()
        return out
