"""Deeply nested pages and texts full of values take time and memory in proportion to their length."""

import time
import tracemalloc

import pytest

from coppice.llm import pii
from coppice.llm.html_blocks import blocks
from coppice.llm.html_extract import Inputs


def measured(run):
    tracemalloc.start()
    began = time.process_time()
    out = run()
    seconds, peak = time.process_time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, seconds, peak


@pytest.mark.parametrize("tag", ["<div>x", "<b><p>x", "<div class='a'>x</i>", "<table><tr><td>x", "<svg><g>x</g></svg>x<div>"])
def test_nested_tags(tag):
    found, seconds, peak = measured(lambda: blocks(tag * 40_000))
    assert len(found) >= 1 and seconds < 10 and peak < 500 << 20
    inputs, seconds, peak = measured(lambda: Inputs([found]))
    assert inputs.sizes.sum() == len(found) and seconds < 10 and peak < 500 << 20


def test_many_values_in_a_text():
    text = " ".join(f"user{i}@mail{i % 97}.example.com" for i in range(40_000))
    seconds = []
    for part in (text[: len(text) // 4], text):
        began = time.process_time()
        found = pii.find(part, b"k" * 32)
        seconds.append(time.process_time() - began)
    assert len(found) == 40_000 and seconds[1] < 8 * seconds[0]
