"""License scan by template markup (operator 8).

Templates with optional and replaceable regions are compiled into automata over words. A text is
accepted where its words, read from some place on, lead an automaton to its end: mandatory wording
has to stand there exactly. All automata of a text run side by side, from every place where a
template may begin, as sets of states.

Texts are cut into words without decoding: A-Z are lower-cased, a word is a run of ASCII letters,
digits and non-ASCII characters. Only texts that hold a mandatory word of a template, found in the
bytes, are read by automata; that leaves nothing out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_class, flat, slices, small_batches, text_of, words
from .license_texts import PHRASES, TEMPLATES

_INSIDE = byte_class(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARKUP = re.compile(r"\[\[|\]\]|<<|>>|\||!!|\{\{(\w+):(\d+)\}\}|[^\W_]+")


@dataclass
class Automaton:
    """States are numbered from 0; ``accept`` is the last. ``words[s]`` leads on by a word,
    ``any_word[s]`` by whatever word, ``free[s]`` without one."""

    label: str
    words: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    any_word: list[int | None] = field(default_factory=lambda: [None])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    required: list[bytes] = field(default_factory=list)
    # Words that may not follow an accepted place.
    barred: set[bytes] = field(default_factory=set)

    @property
    def accept(self) -> int:
        return len(self.words) - 1

    def add(self) -> int:
        self.words.append({})
        self.any_word.append(None)
        self.free.append([])
        return self.accept

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in self.free[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)

    def step(self, states: frozenset[int], word: bytes) -> frozenset[int]:
        out = set()
        for s in states:
            if word in self.words[s]:
                out.add(self.words[s][word])
            if self.any_word[s] is not None:
                out.add(self.any_word[s])
        return self.closure(out)

    def first_words(self) -> set[bytes]:
        return {w for s in self.closure([0]) for w in self.words[s]}


def compile_template(label: str, markup: str) -> Automaton:
    """The automaton of one template. A template has to begin with a word, optional or not."""
    out, opened, after = Automaton(label), [], False
    for found in _MARKUP.finditer(markup):
        piece, now = found.group(), out.accept
        if after:
            out.barred.add(piece.lower().encode())
        elif piece == "!!":
            after = True
        elif piece == "[[":
            opened.append((now, None))
        elif piece == "]]":
            start, ends = _closed(opened, label, ends=False)
            out.free[start].append(out.add())
            out.free[now].append(out.accept)
        elif piece == "<<":
            opened.append((now, []))
        elif piece in ("|", ">>"):
            start, ends = _closed(opened, label, ends=True)
            ends.append(now)
            nxt = out.add()
            if piece == "|":
                out.free[start].append(nxt)
                opened.append((start, ends))
            else:
                for end in ends:
                    out.free[end].append(nxt)
        elif found.group(1):
            entry = now
            skips = [entry]
            for _ in range(int(found.group(2))):
                nxt = out.add()
                out.any_word[skips[-1]] = nxt
                skips.append(nxt)
            end = out.add()
            for s in skips:
                out.free[s].append(end)
        else:
            word = piece.lower().encode()
            nxt = out.add()
            out.words[now][word] = nxt
            if not opened:
                out.required.append(word)
    if opened or not out.required:
        raise ValueError(f"template {label} has an open region or no mandatory word")
    return out


def _closed(opened: list, label: str, ends: bool) -> tuple[int, list[int] | None]:
    """The innermost open region, which has to be of the kind that is closed."""
    if not opened or (opened[-1][1] is not None) != ends:
        raise ValueError(f"template {label} closes a region that is not open")
    return opened.pop()


class Scanner:
    """All phrases and templates together."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [compile_template(k, v) for k, v in phrases.items()]
        self.automata = self.phrases + [compile_template(k, v) for k, v in templates.items()]
        self.begin: dict[bytes, list[int]] = {}
        for k, a in enumerate(self.automata):
            for w in a.first_words():
                self.begin.setdefault(w, []).append(k)
        # A text without any automaton's longest mandatory word matches nothing.
        self.anchors = [max(a.required, key=len) for a in self.automata]

    def scan(self, text: bytes) -> list[tuple[int, int, int]]:
        """(automaton, first word, last word) of every place that is accepted, at its longest."""
        live = {k for k, w in enumerate(self.anchors) if w in text}
        if not live:
            return []
        tokens = _WORD.findall(text)
        out = []
        for i, word in enumerate(tokens):
            for k in self.begin.get(word, ()):
                if k not in live:
                    continue
                a = self.automata[k]
                states, end = a.closure([0]), None
                for j in range(i, len(tokens)):
                    states = a.step(states, tokens[j])
                    if not states:
                        break
                    if a.accept in states and not (j + 1 < len(tokens) and tokens[j + 1] in a.barred):
                        end = j
                if end is not None:
                    out.append((k, i, end))
        return out


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
) -> DataFrame:
    """``id_col``, ``n_words`` and ``matches`` (label, first and last word, whether it is a plain
    phrase) in order of their first word, and ``covered``, the number of words inside matches.

    A NULL or empty text has no words and no matches. NULL and repeated ids keep one row each;
    other columns are not read."""
    inner = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    match = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("phrase", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for batch in batches:
            for part in slices(batch, "text"):
                buf, at = flat(text_of(part.column(1)))
                counts = words(buf, at, _INSIDE)[2]
                lowered = buf.tobytes().translate(_LOWER)
                found, covered = [], np.zeros(part.num_rows, np.int64)
                for k in range(part.num_rows):
                    places = scanner.scan(lowered[at[k] : at[k + 1]])
                    found.append(
                        [
                            {"label": scanner.automata[a].label, "first": i, "last": j, "phrase": a < len(scanner.phrases)}
                            for a, i, j in places
                        ]
                    )
                    reach = -1
                    for _, i, j in sorted(places, key=lambda p: p[1]):
                        covered[k] += max(0, j - max(i - 1, reach))
                        reach = max(reach, j)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts.astype(np.int64)), pa.array(found, pa.list_(match)), pa.array(covered)],
                    ["id", "n_words", "matches", "covered"],
                )

    kind = inner.schema["id"].dataType.simpleString()
    out = inner.mapInArrow(
        run,
        f"id {kind}, n_words long, matches array<struct<label:string,first:long,last:long,phrase:boolean>>, covered long",
    )
    return out.withColumnRenamed("id", id_col)
