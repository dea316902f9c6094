"""Public piece vocabularies (read from a model file, never trained or copied)."""

from __future__ import annotations

import os

PIECE_MODEL = os.environ.get("STRATA_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
SPACE_MARK = "▁".encode()  # stands for a blank in piece vocabularies


def load_pieces(path: str = PIECE_MODEL) -> tuple[list[bytes], list[float], list[str]]:
    """(piece bytes, score, kind) by id; kind is ``normal``, ``byte``, ``unknown`` or ``control``."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names, scores, kinds = [], [], []
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_unknown(i):
            kind = "unknown"
        elif model.is_control(i) or model.is_unused(i):
            kind = "control"
        elif model.is_byte(i):
            kind = "byte"
        else:
            kind = "normal"
        names.append(bytes([int(name[1:-1], 16)]) if kind == "byte" else name.encode())
        scores.append(model.get_score(i))
        kinds.append(kind)
    return names, scores, kinds
