"""What the sentencepiece operators share: the model, the proof of stable
boundaries, and the table of distinct marked words."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

MARK = "▁"
_WORDS = re.compile(f"{MARK}+[^{MARK}]*")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Model:
    """A sentencepiece model with what its vocabulary proves.

    Every symbol that an encoder may build is a piece. So two characters that
    stand side by side in no piece are never in one symbol, and a boundary
    between them is stable whatever surrounds it.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.sp = SentencePieceProcessor(model_file=path)
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        n = proto.normalizer_spec
        self.plain = bool(n.add_dummy_prefix and n.escape_whitespaces and not n.remove_extra_whitespaces and not n.precompiled_charsmap and not proto.trainer_spec.treat_whitespace_as_suffix)
        kinds = type(proto.pieces[0])
        own = [p.piece for p in proto.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED)]
        self.pairs = {p[i : i + 2] for p in own for i in range(len(p) - 1)}
        self.marks_split = self.plain and not any(q[1] == MARK and q[0] != MARK for q in self.pairs)
        self.width = np.zeros(len(proto.pieces), np.int64)
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:  # a character counts at its first byte
                self.width[i] = not 0x80 <= int(p.piece[3:5], 16) <= 0xBF
            elif p.type != kinds.CONTROL:
                self.width[i] = len(p.piece)
        self.narrow = np.uint16 if len(proto.pieces) <= 1 << 16 else np.int32  # what ids fit in
        self.unk = self.sp.unk_id()
        self.mark_id = self.sp.piece_to_id(MARK)

    def stable(self, before: str, after: str) -> bool:
        return (MARK if before == " " else before) + (MARK if after == " " else after) not in self.pairs


@lru_cache(maxsize=4)
def model(path: str) -> Model:
    return Model(path)


def marked_words(text: str) -> list[str]:
    """The words of a text, each without its leading marker."""
    if not text:
        return []
    if MARK not in text and "  " not in text and text[0] != " ":
        return text.split(" ")
    return [w[1:] for w in _WORDS.findall(MARK + text.replace(" ", MARK))]


class WordTable:
    """Distinct marked words and what `value` makes of their ids; each is
    segmented once while it stays. It is emptied beyond `most` entries."""

    def __init__(self, m: Model, value, most: int = 150_000):
        self.m, self.value, self.most, self.known = m, value, most, {}

    def fill(self, words) -> dict:
        known = self.known
        missing = [w for w in words if w not in known]
        if len(known) + len(missing) > self.most:
            self.known = known = {}
            missing = list(words)
        for k in range(0, len(missing), 20_000):
            part = missing[k : k + 20_000]
            for w, ids in zip(part, self.m.sp.encode(part, num_threads=1)):
                known[w] = self.value(ids if w else [self.m.mark_id])
        return known
