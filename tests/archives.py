"""Small archives and a model for tests, written by the library's own publishing functions."""

import itertools
import json
import random
from pathlib import Path

import numpy as np

from skyledger.functions.values import MarketDate, prefix_for_symbol
from skyledger.sources.publish import semantics_fields, write_manifest, write_shard

EXTENSION, FINGERPRINT, EXCHANGE = 42, "quartz-7", "XETR"

#: Four inputs; two LOGISTIC neurons side by side, a ReLU one above them, and two outputs.
MODEL = {
    "input": 4, "output": 2, "forwardOnly": True,
    "neurons": [
        {"type": "hidden", "uuid": "left", "bias": 0.5, "squash": "LOGISTIC"}, {"type": "hidden", "uuid": "right", "bias": -0.25, "squash": "LOGISTIC"}, {"type": "hidden", "uuid": "roof", "bias": 0.125, "squash": "ReLU"},
        {"type": "output", "uuid": "first", "bias": 0.0, "squash": "TANH"}, {"type": "output", "uuid": "second", "bias": 1.5, "squash": "IDENTITY"},
    ],
    "synapses": [
        {"fromUUID": f, "toUUID": t, "weight": w} for f, t, w in (
            ("input-3", "left", 1.25), ("input-0", "left", -0.5), ("input-1", "right", 0.75), ("left", "roof", 2.0), ("right", "roof", -1.0), ("input-2", "roof", 0.25), ("roof", "first", 0.625), ("right", "first", -0.375),
            ("roof", "second", -2.0), ("input-0", "second", 1.0),
        )
    ],
}


def expected(x):
    """The outputs by the formula."""
    logistic = lambda v: 1 / (1 + np.exp(-v))
    left, right = logistic(0.5 + 1.25 * x[3] - 0.5 * x[0]), logistic(0.75 * x[1] - 0.25)
    roof = max(0.0, 0.125 + 2 * left - right + 0.25 * x[2])
    return [np.tanh(0.625 * roof - 0.375 * right), 1.5 - 2 * roof + x[0]]


def place_of(row):
    date = MarketDate.parse(row[1])
    return date.year, date.month, prefix_for_symbol(row[0])


class Fixture:
    """An archive below a folder, to which datasets of rows (symbol, date, values) are added; shards bear their dataset's name."""

    def __init__(self, folder, width):
        self.root, self.written, self.newest = Path(folder) / str(EXTENSION) / FINGERPRINT, semantics_fields(width, EXTENSION, FINGERPRINT), None

    def add(self, dataset, rows):
        groups = itertools.groupby(sorted(rows, key=place_of), key=place_of)
        entries = [write_shard(str(self.root), dataset, self.written, *place, [(s, d, EXCHANGE) for s, d, _ in held], np.array([v for *_, v in held])) for place, held in ((k, list(g)) for k, g in groups)]
        write_manifest(str(self.root), dataset, self.newest, self.written, entries)
        self.newest = dataset

    def files(self, end):
        return sorted(p for p in self.root.rglob(f"*{end}") if p.parent.name != "datasets")

    def edit(self, path, **changes):
        path.write_text(json.dumps(json.loads(path.read_text()) | changes))


def drawn(seed, publications, rows, width, symbols=("AA", "AB", "b", "^X", "3M", "é"), months=3):
    """Publications as lists of (symbol, date, values), each with a symbol and date once."""
    draw, out = random.Random(seed), []
    for k in range(publications):
        keys = {(draw.choice(symbols) + str(draw.randrange(3)), f"2019-{draw.randint(1, months):02}-{draw.randint(1, 28):02}") for _ in range(rows)}
        out.append([(s, d, [float(k), *(float(draw.randint(-9, 9)) for _ in range(width - 1))]) for s, d in sorted(keys)])
    return out


def plain(publications, first="", last="9"):
    """What a reader should give of them: (year, month, prefix, ordinal, symbol, date, values) in order, and how many listings were replaced."""
    held, n = {}, 0
    for rows in publications:
        n += len(rows)
        held |= {(s, d): v for s, d, v in rows}
    replaced = n - len(held)
    kept = sorted(((*place_of((s, d)), s.encode(), d, v) for (s, d), v in held.items() if first <= d <= last), key=lambda r: (r[0], r[1], r[2].encode(), r[3], r[4]))
    out = []
    for _, group in itertools.groupby(kept, key=lambda r: r[:3]):
        out += [(*r[:3], i, r[3].decode(), r[4], r[5]) for i, r in enumerate(group)]
    return out, replaced


def model_file(folder, model=MODEL):
    path = Path(folder) / "model.json"
    path.write_text(json.dumps(model))
    return str(path)
