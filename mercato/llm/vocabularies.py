"""Token ids by the vocabularies of public tokenizers, and the bytes of their tokens."""

from __future__ import annotations

import base64
import os
import re
import sys
import types

#: Characters whose class is the same in all Unicode versions; texts with others take the first library's own splitting.
PLAIN = r"[\t\n\r -~À-ÖØ-öø-ɏ]*"


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable Latin-1 stands for itself, the others follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b) if b in shown else chr(256 + hidden.index(b)): b for b in range(256)}


def in_process(kind, *args):
    """One vocabulary for each Python worker (about 60 MB with both libraries' forms, and it does not grow with the texts):
    the libraries do not give all their memory back, so one for each task would pile up. Functions here are pickled by
    value, so a module of its own holds it."""
    held = sys.modules.setdefault("_mercato_vocabularies", types.ModuleType("_mercato_vocabularies")).__dict__.setdefault("held", {})
    key = (kind.__name__, *args)
    if key not in held:
        held[key] = kind(*args)
    return held[key]


class ByteBpe:
    """Ids by ``tokenizers``; ``ranks``, the same vocabulary in ``tiktoken``'s form, is the faster way for plain texts."""

    def __init__(self, path: str, ranks: str | None = None, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.own = re.compile("|".join(added)) if added and not special_as_text else None  # texts that hold one go the first library's way
        self.plain, self.fast = re.compile(PLAIN), None
        if ranks:
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(t): int(k) for t, k in (line.split() for line in f if line.strip())}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def __call__(self, texts: list[str]) -> list[list[int]]:
        quick = [self.fast is not None and self.plain.fullmatch(t) is not None and not (self.own and self.own.search(t)) for t in texts]
        slow = iter(self.tokenizer.encode_batch_fast([t for t, q in zip(texts, quick) if not q], add_special_tokens=False))
        return [self.fast.encode_ordinary(t) if q else next(slow).ids for t, q in zip(texts, quick)]

    def token_bytes(self) -> list[bytes]:
        letters = byte_letters()
        added = {k: t.content for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        n = self.tokenizer.get_vocab_size()
        return [added[k].encode() if k in added else bytes(letters[c] for c in self.tokenizer.id_to_token(k)) for k in range(n)]


class Pieces:
    """Ids by ``sentencepiece``."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def token_bytes(self) -> list[bytes]:
        m = self.model
        return [bytes([int(m.id_to_piece(k)[3:-1], 16)]) if m.is_byte(k) else m.id_to_piece(k).replace("▁", " ").encode()
                for k in range(m.get_piece_size())]
