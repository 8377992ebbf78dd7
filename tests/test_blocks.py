"""The matcher of long sequences gives the standard one's blocks, and soon."""

import difflib
import random
import time

import pytest

from tidewater.functions import diffs
from tidewater.functions.blocks import Matcher, matcher


def edited(r, items, n, options):
    out = list(items)
    for _ in range(n):
        at = r.randint(0, len(out))
        out[at : at + r.randint(0, 3)] = [r.choice(options) for _ in range(r.randint(0, 3))]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_blocks_opcodes_and_ratios_are_the_standard_ones(seed):
    r = random.Random(seed)
    for _ in range(400):
        letters = "ab cdefghijklmnopqrstuvwxyz😀éßöäü\x00\n"[: r.choice([1, 2, 3, 5, 34])]
        a = [r.choice(letters) for _ in range(r.randint(0, 70))]
        b = edited(r, a, r.randint(0, 7), letters) if r.random() < 0.5 else [r.choice(letters) for _ in range(r.randint(0, 70))]
        a, b = ("".join(a), "".join(b)) if r.random() < 0.5 else (a, b)
        own, standard = Matcher(a, b), difflib.SequenceMatcher(None, a, b, autojunk=False)
        assert own.get_matching_blocks() == standard.get_matching_blocks(), (a, b)
        assert (own.get_opcodes(), own.ratio(), own.quick_ratio()) == (standard.get_opcodes(), standard.ratio(), standard.quick_ratio())
        lo, hi = sorted(r.randint(0, len(a)) for _ in range(2))
        assert Matcher(a, b).find_longest_match(lo, hi, 0, len(b)) == standard.find_longest_match(lo, hi, 0, len(b))


def test_long_texts_take_seconds():
    r = random.Random(1)
    words = " ".join(f"w{r.randint(0, 300)}" for _ in range(60_000))[:250_000]
    lines = [r.choice(["", "", "}", f"x = {r.randint(0, 50)}", f"y{r.randint(0, 9999)}"]) for _ in range(60_000)]
    repeated = ("ab" * 60_000, "ba" * 60_000)
    for a, b, least in ((words, "".join(edited(r, words, 20, words)), 0.99), (lines, edited(r, lines, 300, lines), 0.98), (*repeated, 0.99)):
        began = time.process_time()
        m = matcher(a, b)
        assert isinstance(m, Matcher) and m.ratio() > least and time.process_time() - began < 40
    old, new = "\n".join(lines), "\n".join(lines[:30_000] + ["new"] + lines[30_000:])
    assert diffs.changed_lines(old, new) == 1 and diffs.anchors(old, new) == (["new"], []) and diffs.similarity(old[:60_000], old[:60_000] + "x") > 0.9999
