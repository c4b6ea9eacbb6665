"""Chat formatting: turns as marked text, a parser that reads them back, escapes only where both disagree.

Grammar of a formatted conversation::

    conversation = turn*
    turn         = opening " " text " " closing "\\n"        a role with markers of its own
                 | opening name "\\n" text " " closing "\\n"  any other role, its name quoted

A control string inside a text ends the parse there. Escaped, it has one more
backslash after its first character; a reader takes one away. Markers hold no
white space, so that none can arise across the border of a text.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from urllib.parse import quote, unquote

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from aftermath.llm.shared import Workspace


class GrammarError(ValueError):
    """What is read does not follow the grammar from ``place`` on."""

    def __init__(self, place: int, turns: list):
        super().__init__(f"no turn at {place}")
        self.place, self.turns = place, turns


@dataclass(frozen=True)
class Turn:
    """A turn as read: its role, its text with escapes, and where that stands."""

    role: str
    body: str
    start: int
    end: int


@dataclass(frozen=True)
class Template:
    """Opening and closing markers of the roles, and the roles whose texts are learned."""

    markers: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
    )
    other: tuple[str, str] = ("[TURN]", "[/TURN]")
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        controls = self.controls
        if len(set(controls)) < len(controls):
            raise ValueError("markers must differ")
        for one in controls:
            if len(one) < 2 or re.search(r"[\s\\]", one):
                raise ValueError(f"marker {one!r} needs two characters or more and neither white space nor backslashes")
            for tail in (one[i:] for i in range(len(one))):
                if any(x != tail and (x.startswith(tail) or tail.startswith(x)) or (x == tail and tail != one) for x in controls):
                    raise ValueError(f"marker {one!r} overlaps another one")

    @property
    def controls(self) -> list[str]:
        return [marker for pair in (*self.markers.values(), self.other) for marker in pair]

    @cached_property
    def _control(self) -> re.Pattern:
        """A control string with any number of backslashes after its first character."""
        firsts: dict[str, list[str]] = {}
        for marker in self.controls:
            firsts.setdefault(marker[0], []).append(marker[1:])
        kinds = [f"{re.escape(a)}\\\\*(?:{'|'.join(map(re.escape, rest))})" for a, rest in sorted(firsts.items())]
        return re.compile("|".join(kinds))

    @cached_property
    def _plain(self) -> re.Pattern:
        return re.compile("|".join(map(re.escape, self.controls)))

    @cached_property
    def _roles(self) -> dict[str, str]:
        return {pair[0]: role for role, pair in self.markers.items()}

    @property
    def control_pattern(self) -> str:
        """The regular expression of control strings, escaped or not."""
        return self._control.pattern

    def escaped(self, text: str) -> str:
        return self._control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescaped(self, text: str) -> str:
        return self._control.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)

    def written(self, role: str, body: str) -> str:
        """One turn; ``body`` as it is."""
        if role in self.markers:
            opening, closing = self.markers[role]
            return f"{opening} {body} {closing}\n"
        return f"{self.other[0]}{quote(role, safe='')}\n{body} {self.other[1]}\n"

    def parsed(self, text: str) -> list[Turn]:
        """The turns of a formatted text; ``GrammarError`` with those before it at the first fault."""
        turns, place = [], 0
        while place < len(text):
            opening = self._plain.match(text, place)
            if opening is None:
                raise GrammarError(place, turns)
            if opening[0] in self._roles:
                role, start = self._roles[opening[0]], opening.end() + 1
                closing = self.markers[role][1]
                sound = text.startswith(" ", start - 1)
            elif opening[0] == self.other[0] and (line := text.find("\n", opening.end())) >= 0:
                role, start, closing = unquote(text[opening.end() : line]), line + 1, self.other[1]
                sound = True
            else:
                raise GrammarError(place, turns)
            end = self._plain.search(text, start)
            if not sound or end is None or end[0] != closing or end.start() <= start or text[end.start() - 1] != " ":
                raise GrammarError(place, turns)
            if not text.startswith("\n", end.end()):
                raise GrammarError(place, turns)
            turns.append(Turn(role, text[start : end.start() - 1], start, end.start() - 1))
            place = end.end() + 1
        return turns

    def recovered(self, text: str) -> list[tuple[str, str]]:
        """Roles and texts as far as a formatted text can be read."""
        try:
            turns = self.parsed(text)
        except GrammarError as fault:
            turns = fault.turns
        return [(turn.role, self.unescaped(turn.body)) for turn in turns]

    def formatted(self, turns: list[tuple[str, str]]) -> str:
        """The turns as text that reads back as they are.

        The text is read back and the first turn that differs is escaped, until
        none does. Nothing before a turn changes how it is read, so one
        pass over the turns comes to the same as reading all of them each time.
        """
        pieces = []
        for turn in turns:
            piece = self.written(*turn)
            if self.recovered(piece) != [turn]:
                piece = self.written(turn[0], self.escaped(turn[1]))
                if self.recovered(piece) != [turn]:
                    raise AssertionError(f"{turn!r} does not survive its escapes")
            pieces.append(piece)
        return "".join(pieces)


def _hash(role: str, text: str) -> int:
    mark = xxhash.xxh64(f"{len(role)}:{role}{text}".encode(), seed=42).intdigest()
    return mark - (1 << 64) if mark >> 63 else mark


TURNS = "conv_id long, turn long, role string, formatted string, mask_start int, mask_end int, source_hash long"


def formatted_turns(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, turn, role, formatted, mask_start, mask_end, source_hash) of every row of ``conversations``.

    ``formatted`` is the turn's part of its conversation's text: the parts in
    order of turn, then of themselves, are the whole. The characters from
    ``mask_start`` to before ``mask_end`` of it are learned (null: none).
    ``source_hash`` marks role and text, to compare what is read back.
    A null role or text is empty; a null turn comes after all others; rows with
    a null conversation are one conversation. Repeated rows are turns of their
    own. Texts may be of any length, but a text has to fit in memory.
    Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, starts, ends, marks = [], [], [], []
            roles = [x or "" for x in batch.column(2).to_pylist()]
            for role, text in zip(roles, batch.column(3)):
                text = text.as_py() or ""
                piece = template.formatted([(role, text)])
                (turn,) = template.parsed(piece)
                learned = role in template.learned
                pieces.append(piece)
                starts.append(turn.start if learned else None)
                ends.append(turn.end if learned else None)
                marks.append(_hash(role, text))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(roles, pa.string()), pa.array(pieces, pa.string()),
                    pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(marks, pa.int64()),
                ],
                ["conv_id", "turn", "role", "formatted", "mask_start", "mask_end", "source_hash"],
            )

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, TURNS)


class _Conversation:
    """Running digests of one conversation that is read back part by part."""

    def __init__(self):
        self.turns = self.loss = self.formatted = 0
        self.turns_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()

    def add(self, template: Template, piece: str, start: int | None, end: int | None, mark: int) -> None:
        for turn in template.parsed(piece):
            text = template.unescaped(turn.body)
            if _hash(turn.role, text) != mark:
                raise AssertionError("a turn was not recovered")
            self.turns += 1
            self.turns_digest.update(f"{turn.role}\n{text}\n".encode())
        if start is not None:
            learned = template.unescaped(piece[start:end])
            self.loss += len(learned)
            self.loss_digest.update(learned.encode())
        self.formatted += len(piece)

    def row(self) -> tuple:
        return self.turns, self.turns_digest.hexdigest(), self.loss, self.loss_digest.hexdigest(), self.formatted


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of each conversation in ``formatted_turns``.

    All is read back from the formatted text and its mask; a turn that differs
    from its source is an error. A conversation's turns pass through one task,
    one after the other, because its digests follow their order; nothing of
    them is kept but the running digests.
    """
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in DIGESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, done = None, None, []

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names)

        for batch in batches:
            ids, starts, ends, marks = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            for i, piece in enumerate(batch.column(1)):
                if held is None or ids[i] != current:
                    if held is not None:
                        done.append((current, *held.row()))
                    current, held = ids[i], _Conversation()
                held.add(template, piece.as_py(), starts[i], ends[i], marks[i])
            if len(done) > 1000:
                yield out(done)
                done = []
        if held is not None:
            done.append((current, *held.row()))
        yield out(done)

    order = [F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("formatted")]
    dealt = turns.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", "formatted", "mask_start", "mask_end", "source_hash").mapInArrow(run, DIGESTS)


def round_trip(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """The digests of all ``conversations``, formatted to the shared folder and read back from there."""
    space = Workspace(conversations.sparkSession, "chat")
    return digests(space.write(formatted_turns(conversations, template), "formatted"), template)
