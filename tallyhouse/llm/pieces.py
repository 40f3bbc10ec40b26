"""SentencePiece ids by a table of last tokens of prefixes.

For merge-type (BPE) models. A row of tokens is what merging gives exactly if each
two neighbours are: merging their joined text alone leaves these two. So each
prefix of a text has one last token, which is the token that ends there, begins
where another prefix ends, and is compatible with that prefix's last token. An
automaton finds the tokens that end at each place; the table of last tokens is
filled from the left, and the ids are read from it backwards.

A text is first cut where no token can reach over: between two characters that
are neighbours in no token. Parts that came before are remembered.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, functions as F
from sentencepiece import sentencepiece_model_pb2 as model_format

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Parts of texts that a worker remembers.
REMEMBERED = 300_000

_LETTER = r"[^\W\d_]"
_WORD = r" +[^ ]*"
#: Words apart from the other characters at their ends, each with the spaces before.
_FINER = rf" *{_LETTER}+| *(?:[^\w ]|[\d_])+| +"


class PieceCodec:
    """Ids of texts as the sentencepiece library gives them, and texts of ids."""

    def __init__(self, model_file: str, remembered: int = REMEMBERED):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        model = model_format.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        spec = model.normalizer_spec
        kinds = {piece.type for piece in model.pieces}
        if (
            model.trainer_spec.model_type != model_format.TrainerSpec.BPE or model.trainer_spec.treat_whitespace_as_suffix
            or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces
            or not spec.add_dummy_prefix or kinds & {USER_DEFINED, UNUSED}
        ):
            raise ValueError("needs a BPE model that changes nothing in a text but its spaces")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.text = {i: p for p, i in self.ids.items()}
        self.cost = {i: -model.pieces[i].score for i in self.text}
        unknown = self.library.unk_id()
        self.bytes_of = {}
        if model.trainer_spec.byte_fallback:
            self.bytes_of = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = unknown
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.ids):
            raise ValueError("a piece holds a space after another character")
        self.inside = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        # The finer cut is right where no piece joins a letter and another character.
        letter = re.compile(_LETTER).match
        mixed = {p for p in self.inside if BLANK not in p and bool(letter(p[0])) != bool(letter(p[1]))}
        self.odd = re.compile("|".join(map(re.escape, mixed))) if mixed else None
        self.finer, self.coarse = re.compile(_FINER), re.compile(_WORD)
        self.halves: dict[int, tuple[int, int]] = {}
        self.plain: set[int] = set()
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self._is_whole(piece, i):
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.remembered = remembered

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Merging by its definition, for short texts: the best pair first, the
        leftmost of equally good ones. Also the two parts of the last merge."""
        parts, last = list(text), None
        while True:
            best = min(
                ((self.cost[self.ids[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ids),
                default=None,
            )
            if best is None:
                return parts, last
            k = best[1]
            last = parts[k], parts[k + 1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def _is_whole(self, piece: str, i: int) -> bool:
        """Whether merging makes this piece from its own text; notes its two halves."""
        if len(piece) == 1:
            self.halves[i] = (i, i)
            self.plain.add(i)
            return True
        if any(c not in self.ids for c in piece):
            return False
        parts, last = self.merged(piece)
        if len(parts) > 1:
            return False
        left, right = self.ids[last[0]], self.ids[last[1]]
        self.halves[i] = left, right
        if all(len(self.text[h]) == 1 or self.cost[h] < self.cost[i] for h in (left, right)):
            self.plain.add(i)
        return True

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' joined text leaves just these two."""
        answer = self.pairs.get((left, right))
        if answer is None:
            if len(self.pairs) >= self.remembered:
                self.pairs.clear()
            answer = self.pairs[left, right] = self._compatible(left, right)
        return answer

    def _compatible(self, left: int, right: int) -> bool:
        a, b = left, right
        # Time runs backwards over the merges that touch the border from either
        # side. limit: the cost a merge over the border has to stay below while a
        # and b face each other there; ties go to the leftmost pair.
        limit, or_equal = float("inf"), False
        while True:
            if a not in self.plain or b not in self.plain:
                both = self.text[left], self.text[right]
                return self.merged(both[0] + both[1])[0] == list(both)
            over = self.ids.get(self.text[a] + self.text[b])
            if over is not None and (self.cost[over] < limit or or_equal and self.cost[over] == limit):
                return False
            one_a, one_b = len(self.text[a]) == 1, len(self.text[b]) == 1
            if one_a and one_b:
                return True
            # The later of the two merges is undone first; of equal ones the right.
            if one_a or not one_b and self.cost[b] >= self.cost[a]:
                limit, or_equal, b = self.cost[b], True, self.halves[b][0]
            else:
                limit, or_equal, a = self.cost[a], False, self.halves[a][1]

    def _part_ids(self, part: str) -> list[int]:
        """Ids of a part whose characters are all pieces."""
        pairs = self.pairs
        last, size = [0] * (len(part) + 1), [0] * (len(part) + 1)
        for end, (i, length) in self.automaton.iter(part):
            end += 1
            if size[end]:
                continue
            before = end - length
            if before:
                fits = pairs.get((last[before], i))
                if fits is None:
                    fits = self.compatible(last[before], i)
                if not fits:
                    continue
            last[end], size[end] = i, length
        ids, place = [], len(part)
        while place:
            ids.append(last[place])
            place -= size[place]
        return ids[::-1]

    def _word_ids(self, word: str) -> tuple[int, ...]:
        ids: list[int] = []
        word = word.replace(" ", BLANK)
        start = 0
        for k in range(1, len(word) + 1):
            if k < len(word) and word[k - 1:k + 1] in self.inside:
                continue
            part, start = word[start:k], k
            if len(part) == 1 and part not in self.ids:
                ids += [self.bytes_of[b] for b in part.encode()] if self.bytes_of else [self.unknown]
            elif len(part) == 1:
                ids.append(self.ids[part])
            else:
                ids += self._part_ids(part)
        return tuple(ids)

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text, without begin or end; none for a null or empty one."""
        ids: list[int] = []
        if not text:
            return ids
        known = self.known
        # A blank in the text is the same as a space; the model puts a space before.
        text = " " + text.replace(BLANK, " ")
        cut = self.coarse if self.odd and self.odd.search(text) else self.finer
        for word in cut.findall(text):
            found = known.get(word)
            if found is None:
                if len(known) >= self.remembered:
                    known.clear()
                found = known[word] = self._word_ids(word)
            ids += found
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


@functools.lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    """One codec a worker."""
    return PieceCodec(model_file)


def encode_decode(text: Column, model_file: str) -> Column:
    """(ids, decoded) of a text, by the BPE model in a file that every executor has.

    ids are the library's, without begin or end; decoded is the library's text of
    them. A null text is read as an empty one, which has no ids. The model must
    leave texts as they are but for spaces; others raise ValueError.
    """

    @F.arrow_udf("ids array<int>, decoded string")
    def run(texts: pa.Array) -> pa.Array:
        own = codec(model_file)
        ids = [own.encode(text.as_py()) for text in texts]
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.list_(pa.int32())), pa.array([own.decode(i) for i in ids], pa.string())],
            names=["ids", "decoded"],
        )

    return run.asNondeterministic()(text)
