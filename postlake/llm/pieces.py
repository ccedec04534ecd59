"""SentencePiece BPE encoding by backtracking, and its decoding.

A text is cut where no piece of the vocabulary can span (before a space that follows a
non-space), and each part is encoded on its own: all vocabulary matches come from one
Aho-Corasick pass; the longest match is tried first at each position and kept only if it
is compatible with the token before it, that is if merging the two from characters gives
back exactly these two tokens.  A position from which nothing fits is marked in a
bitfield and never tried again.  The prefix of a BPE encoding is the encoding of that
prefix, so the first sequence that reaches the end is the library's.
"""

from __future__ import annotations

import ahocorasick
import sentencepiece

SPACE = "▁"
MEMO = 250_000  # parts remembered per generation; memory only, never results


def merge(text: str, scores: dict[str, float], log: list | None = None) -> list[str]:
    """Plain merging: the best-scored neighbouring pair first, the leftmost among equals.

    ``log`` receives each merge as (left, right, score).
    """
    parts = list(text)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if best is None:
            break
        if log is not None:
            log.append((at, parts[at], parts[at + 1], best))
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class PieceCodec:
    """Encoder and decoder of one merge-type model with an identity normalizer."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        names = [model.id_to_piece(i) for i in range(size)]
        self.ids = {names[i]: i for i in range(size) if not special[i]}
        self.scores = {names[i]: model.get_score(i) for i in range(size) if not special[i]}
        self.bytes = {int(names[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.unknown = model.unk_id()
        if any(model.is_unused(i) for i in range(size)):
            raise ValueError("models with unused pieces are not handled")
        self.words = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        probe = " é é  ﬁＡ\t① "
        if model.decode(model.encode(probe)) != probe:
            raise ValueError("only models that keep texts as they are are handled")
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.pieces = {i: names[i].replace(SPACE, " ") for i in range(size) if not special[i]}
        self.texts = {piece: f",{i}" for piece, i in self.ids.items()}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.spines: dict[str, tuple[list, list] | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.shorter: dict[str, str] = {}
        self.memo: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.odd: set[str] = set()

    def edges(self, token: str) -> tuple[list, list] | None:
        """The symbols at a token's left and right edge as it is merged from characters.

        Each comes with the score of the merge that absorbs it.  None if the token does
        not merge from its own characters, or not in falling order of score.
        """
        if token in self.spines:
            return self.spines[token]
        log: list = []
        found = None
        if merge(token, self.scores, log) == [token]:
            order = [step[3] for step in log]
            if all(a >= b for a, b in zip(order, order[1:])):
                left, right = [], []
                size = len(token)
                for at, a, b, score in log:
                    if at == 0:
                        left.append((a, score))
                    size -= 1
                    if at == size - 1:
                        right.append((b, score))
                found = left + [(token, None)], right + [(token, None)]
        self.spines[token] = found
        return found

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the two together leaves them as they are."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            known = self.pairs[key] = self.merged_apart(left, right)
        return known

    def merged_apart(self, left: str, right: str) -> bool:
        """The two re-merged side by side.

        As long as they are not whole, the better of their next merges at the common
        edge is done, unless the symbols that meet there merge first.
        """
        a, b = self.edges(left), self.edges(right)
        if a is None or b is None:
            return merge(left + right, self.scores) == [left, right]
        ends, starts = a[1], b[0]
        i = j = 0
        while True:
            x, inner = ends[i]
            y, outer = starts[j]
            cross = self.scores.get(x + y)
            if cross is not None and (inner is None or cross > inner) and (outer is None or cross >= outer):
                return False
            if inner is None and outer is None:
                return True
            if outer is None or inner is not None and inner >= outer:
                i += 1
            else:
                j += 1

    def shortened(self, token: str) -> str:
        """The longest shorter piece that starts the token; at the least, its first character."""
        found = self.shorter.get(token)
        if found is None:
            size = len(token) - 1
            while size > 1 and token[:size] not in self.ids:
                size -= 1
            found = self.shorter[token] = token[:size] if len(token) > 1 else ""
        return found

    def split(self, text: str) -> list[str]:
        """The tokens of one part, as strings; characters outside the vocabulary stay alone."""
        size = len(text)
        longest: dict[int, int] = {}
        for end, length in self.automaton.iter(text):
            longest[end - length + 1] = length  # ends grow: the longest match of a start stays
        failed = 0
        tokens: list[str] = []
        at, last = 0, ""
        token = text[:longest.get(0, 1)]
        pairs = self.pairs
        while at < size:
            while token:
                if not failed >> at + len(token) & 1:
                    fits = not last or pairs.get((last, token))
                    if fits or fits is None and self.compatible(last, token):
                        break
                token = self.shortened(token)
            if token:
                tokens.append(token)
                at += len(token)
                last = token
                token = text[at:at + longest.get(at, 1)]
            elif not tokens:
                return merge(text, self.scores)
            else:
                failed |= 1 << at
                token = tokens.pop()
                at -= len(token)
                last = tokens[-1] if tokens else ""
                token = self.shortened(token)
        return tokens

    def part_ids(self, part: str) -> list[int]:
        out: list[int] = []
        for token in self.split(part):
            known = self.ids.get(token)
            if known is not None:
                out.append(known)
            elif self.bytes:
                out.extend(self.bytes[b] for b in token.encode())
            else:
                out.append(self.unknown)
        return out

    def remembered(self, part: str) -> str:
        """The ids of a part as text, each after a comma."""
        found = self.memo.get(part)
        if found is None:
            found = self.older.get(part)
            if found is None:
                try:
                    found = "".join([self.texts[t] for t in self.split(part)])
                except KeyError:  # characters outside the vocabulary
                    ids = self.part_ids(part)
                    found = "".join([f",{i}" for i in ids])
                    if self.joined(ids) != part.replace(SPACE, " "):
                        self.odd.add(part)
            if len(self.memo) >= MEMO:
                self.older, self.memo = self.memo, {}
                self.odd &= self.older.keys()
            self.memo[part] = found
        return found

    def parts(self, text: str) -> list[str]:
        """The text with its spaces marked and a space put before it, cut into parts."""
        if not text:
            return []
        if SPACE in text:  # the mark itself stands for a space, too
            text = text.replace(SPACE, " ")
        words = text.split(" ")
        if not self.words:
            return [SPACE + text.replace(" ", SPACE)]
        if "" not in words:
            return [SPACE + w for w in words]
        out, run = [], ""
        for word in words:
            run += SPACE
            if word:
                out.append(run + word)
                run = ""
        if run:
            out.append(run)
        return out

    def joined(self, ids: list[int]) -> str:
        """Pieces and runs of byte tokens as text, with the space before the text."""
        out: list[str] = []
        run = bytearray()
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                run.append(byte)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.pieces.get(i, " ⁇ " if i == self.unknown else ""))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def encode(self, text: str) -> list[int]:
        return [i for part in self.parts(text) for i in self.part_ids(part)]

    def decode(self, ids: list[int]) -> str:
        text = self.joined(ids)
        return text[1:] if text.startswith(" ") else text

    def coded(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids joined by commas, and the decoded text."""
        parts = self.parts(text)
        memo = self.memo
        for part in set(parts).difference(memo):
            self.remembered(part)
        try:
            joined = "".join([memo[p] for p in parts])
        except KeyError:  # the memo began a new generation meanwhile
            joined = "".join([self.remembered(p) for p in parts])
        joined = joined[1:]
        count = joined.count(",") + 1 if joined else 0
        if self.odd and not self.odd.isdisjoint(parts):
            return count, joined, self.decode([int(i) for i in joined.split(",")])
        return count, joined, text.replace(SPACE, " ")


_CODECS: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """One codec per model and worker process."""
    if model_file not in _CODECS:
        _CODECS[model_file] = PieceCodec(model_file)
    return _CODECS[model_file]
