"""The scan finds what exact containment over all windows finds."""

import random
import re

import pytest

from galetrack.llm import licenses


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def exact(text, templates, least):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    for name, template in templates.items():
        known = [w for w in re.split(r"[\W_]+", template.lower()) if w]
        s = 1 << (len(known) - 1).bit_length()
        want = set(shingles(known))
        best = max((len(want & set(shingles(words[i : i + 2 * s]))) / len(want) for i in range(0, len(words), s)), default=0)
        if best >= least:
            yield name, round(best, 9)


@pytest.mark.parametrize("templates", [licenses.TEMPLATES, {"six": "free for all to use here", "nine": "you may copy this text if you keep it"}])
def test_scan_equals_exact_containment(spark, templates):
    rng, rows = random.Random(4), []
    for i in range(1500):
        name = ("mit-line" if i % 3 else rng.choice(sorted(templates))) if "mit-line" in templates else rng.choice(sorted(templates))
        notice = templates[name].split()
        if i % 5 == 0:
            notice[rng.randrange(len(notice))] = "changed"
        pad = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        # Places whose notice lies in one window only, of all its size.
        at = 16 + 8 * rng.randrange(3) + 4 + rng.randrange(4)
        rows.append((i, " ".join([*pad[:at], *notice, *pad[at:]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r["doc_id"], r["license"], round(r["containment"], 9)) for r in licenses.scan(docs, templates=templates).collect())
    assert got == sorted((i, *found) for i, text in rows for found in exact(text, templates, 0.8))
