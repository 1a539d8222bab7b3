"""Feed-forward networks: loading, compiling, and scoring rows in Arrow batches.

A neuron's value is its bias plus its weighted inputs, added in synapse order in single precision, through its squash.
Neurons are computed level by level for many rows at a time; as every row's sums are formed in the same order, a row's
outputs do not depend on the batch it is in. Squashes that are not known are refused.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.columns import first_inputs
from skyledger.functions.values import sha256_hex
from skyledger.sources.files import read_bytes

#: Part of every run's key: predictions of another kernel never share it.
ENGINE, ENGINE_VERSION, ENGINE_SOURCE = "skyledger/levels-f32", "1", "python"
ONE = np.float32(1)


def _logistic(v: np.ndarray) -> None:
    np.negative(v, out=v)
    np.exp(v, out=v)
    np.add(v, ONE, out=v)
    np.divide(ONE, v, out=v)


#: Each works in place.
SQUASHES: dict[str, Callable[[np.ndarray], object]] = {
    "IDENTITY": lambda v: None,
    "TANH": lambda v: np.tanh(v, out=v),
    "ReLU": lambda v: np.maximum(v, np.float32(0), out=v),
    "LOGISTIC": _logistic,
}
COLUMN_SQUASHES: dict[str, Callable[[Column], Column]] = {
    "IDENTITY": lambda v: v,
    "TANH": lambda v: F.tanh(v),
    "ReLU": lambda v: F.greatest(v, F.lit(0.0)),
    "LOGISTIC": lambda v: 1 / (1 + F.exp(-v)),
}
_INPUT = re.compile(r"input-(0|[1-9][0-9]*)")
#: Values of the activation matrix that a task holds at a time, and rows of it.
MATRIX_VALUES, STEP_ROWS = 8_000_000, 256


class EngineError(Exception):
    """``kind``: io, creature, not_forward_only, wider_than_archive or batch_shape."""

    def __init__(self, kind: str, message: str):
        super().__init__(kind, message)
        self.kind, self.message = kind, message

    def __str__(self) -> str:
        return self.message


@dataclass(frozen=True)
class Creature:
    """A model file: its path, hash and contents."""

    path: str
    sha256: str
    export: dict

    @property
    def identity(self) -> str:
        return f"sha256:{self.sha256}"


def _parse(text: str) -> dict:
    """The model, with types checked; ValueError otherwise."""
    found = json.loads(text)
    if not isinstance(found, dict):
        raise ValueError("not an object")
    for name in ("input", "output"):
        if type(found.get(name)) is not int or found[name] < 1:
            raise ValueError(f"{name} must be a whole number of at least 1")
    if type(found.get("forwardOnly")) is not bool:
        raise ValueError("forwardOnly must be true or false")
    text, number = {str}, {int, float}
    forms = {"neurons": {"type": text, "uuid": text, "bias": number, "squash": text}, "synapses": {"fromUUID": text, "toUUID": text, "weight": number}}
    for part, fields in forms.items():
        items = found.get(part)
        if not isinstance(items, list) or not {type(x) for x in items} <= {dict}:
            raise ValueError(f"{part} must be a list of objects")
        for name, kinds in fields.items():
            if not {type(x.get(name)) for x in items} <= kinds:
                raise ValueError(f"{part}: {name} is missing or of another type")
    return found


def load_creature(path: str) -> Creature:
    try:
        data = read_bytes(path)
    except OSError as e:
        raise EngineError("io", f"model {path} can't be read: {e}") from None
    try:
        return Creature(path, sha256_hex(data), _parse(data.decode()))
    except UnicodeDecodeError as e:
        raise EngineError("creature", f"model {path} is no UTF-8 text: {e}") from None
    except (ValueError, RecursionError) as e:
        raise EngineError("creature", f"model {path} can't be used: {e}") from None


@dataclass
class Level:
    """Neurons that only need earlier ones: nodes ``low`` to ``high``. The k-th inputs of the first so many that have them: sources, weights.
    Runs of neurons with one squash: its name, from, to."""

    low: int
    high: int
    bias: np.ndarray
    inputs: list[tuple[np.ndarray, np.ndarray]]
    squashes: list[tuple[str, int, int]]


def compiled(export: dict) -> tuple[int, list[Level], np.ndarray]:
    """The number of nodes, the levels, and the nodes of the outputs; ValueError for a graph that is none. Nodes are the inputs and then the
    neurons level by level, those with most inputs first, so that a level's values lie together and are made where they stay."""
    n_in, neurons = export["input"], export["neurons"]
    node = {x["uuid"]: n_in + i for i, x in enumerate(neurons)}
    if len(node) < len(neurons):
        raise ValueError("two neurons share a uuid")
    incoming: list[list[tuple[int, float]]] = [[] for _ in neurons]
    sources = node | {f"input-{i}": i for i in range(n_in)}
    for s in export["synapses"]:
        source, target = sources.get(s["fromUUID"]), node.get(s["toUUID"])
        if source is None or source >= n_in and _INPUT.fullmatch(s["fromUUID"]):
            raise ValueError(f"synapse from {s['fromUUID']}, which is no neuron and none of the {n_in} inputs")
        if target is None:
            raise ValueError(f"synapse to unknown neuron {s['toUUID']}")
        incoming[target - n_in].append((source, s["weight"]))
    for x in neurons:
        if x["squash"] not in SQUASHES:
            raise ValueError(f"unknown squash {x['squash']}")
        if x["type"] not in ("hidden", "output"):
            raise ValueError(f"unknown neuron type {x['type']}")
    outputs = [n_in + i for i, x in enumerate(neurons) if x["type"] == "output"]
    if len(outputs) != export["output"]:
        raise ValueError(f"{len(outputs)} output neurons, but output is {export['output']}")
    depth = [0] * n_in + [-1] * len(neurons)
    waiting = [sum(src >= n_in for src, _ in held) for held in incoming]
    after: list[list[int]] = [[] for _ in neurons]
    for i, held in enumerate(incoming):
        for src, _ in held:
            if src >= n_in:
                after[src - n_in].append(i)
    ready = [i for i, w in enumerate(waiting) if not w]
    done = 0
    while ready:
        i = ready.pop()
        done += 1
        depth[n_in + i] = 1 + max((depth[src] for src, _ in incoming[i]), default=0)
        for j in after[i]:
            waiting[j] -= 1
            if not waiting[j]:
                ready.append(j)
    if done < len(neurons):
        raise ValueError("the network has a cycle")
    at_level: dict[int, list[int]] = {}
    for i in range(len(neurons)):
        at_level.setdefault(depth[n_in + i], []).append(i)
    order = [sorted(at_level[at], key=lambda i: (-len(incoming[i]), neurons[i]["squash"], i)) for at in sorted(at_level)]
    moved = np.arange(n_in + len(neurons))
    moved[[n_in + i for own in order for i in own]] = np.arange(n_in, n_in + len(neurons))
    levels, low = [], n_in
    for own in order:
        inputs = []
        for k in range(len(incoming[own[0]])):
            m = sum(len(incoming[i]) > k for i in own)  # the widest neurons come first
            inputs.append((moved[[incoming[i][k][0] for i in own[:m]]], np.array([incoming[i][k][1] for i in own[:m]], np.float64).astype(np.float32)[:, None]))
        runs = [(name, [p for p, _ in held]) for name, held in groupby(enumerate(own), key=lambda x: neurons[x[1]]["squash"])]
        levels.append(Level(low, low + len(own), np.array([neurons[i]["bias"] for i in own], np.float64).astype(np.float32)[:, None], inputs, [(name, p[0], p[-1] + 1) for name, p in runs]))
        low += len(own)
    return n_in + len(neurons), levels, moved[outputs]


class Predictor:
    """A compiled model for rows of ``stride`` values; values beyond the model's inputs are ignored."""

    def __init__(self, creature: Creature, archive_input_count: int, like: Predictor | None = None):
        """``like``: the same model, compiled for another width."""
        export = creature.export
        if not export["forwardOnly"]:
            raise EngineError("not_forward_only", "only models with forwardOnly true can be scored row by row")
        if export["input"] > archive_input_count:
            raise EngineError(
                "wider_than_archive",
                f"the model reads {export['input']} values a row, more than the {archive_input_count} that the archive has",
            )
        try:
            self.nodes, self.levels, self.outputs = (like.nodes, like.levels, like.outputs) if like else compiled(export)
        except ValueError as e:
            raise EngineError("creature", f"model {creature.path} can't be used: {e}") from None
        self.input_count, self.output_count, self.stride = export["input"], export["output"], archive_input_count

    def activate(self, rows: np.ndarray) -> np.ndarray:
        """Outputs of a matrix of rows, a row each."""
        step = max(1, min(STEP_ROWS, MATRIX_VALUES // self.nodes))
        out = np.empty((len(rows), self.output_count), np.float32)
        with np.errstate(all="ignore"):
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                value = np.empty((self.nodes, len(part)), np.float32)
                value[: self.input_count] = part[:, : self.input_count].T
                for level in self.levels:
                    total = value[level.low : level.high]
                    total[:] = level.bias
                    for source, weight in level.inputs:
                        term = value[source]
                        term *= weight
                        total[: len(term)] += term
                    for name, low, high in level.squashes:
                        SQUASHES[name](total[low:high])
                out[at : at + step] = value[self.outputs].T
        return out

    def predict(self, flat: np.ndarray) -> np.ndarray:
        """Outputs of whole rows that lie end to end, likewise end to end."""
        flat = np.asarray(flat, np.float32)
        if flat.size % self.stride:
            raise EngineError("batch_shape", f"{flat.size} values do not make whole rows of {self.stride}")
        return self.activate(flat.reshape(-1, self.stride)).reshape(-1)

    def activate_one(self, row: np.ndarray) -> np.ndarray:
        return self.predict(row)


def score(rows: DataFrame, predictor: Predictor, inputs: str = "x", outputs: str = "y") -> DataFrame:
    """Replaces the observations by the model's outputs (array of float), in Arrow batches and without a shuffle. A row
    without observations has no outputs; one of another width is a ``batch_shape`` fault."""
    source = rows.select("*", rows[inputs].alias("_observations")).drop(inputs, outputs)  # batches know columns by place: it is the last
    kept = source.schema.fields[:-1]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"`{outputs}` array<float>"])
    model = rows.sparkSession.sparkContext.broadcast(predictor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(len(kept))
            there = np.flatnonzero(np.asarray(x.is_valid()))
            flat = x.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
            m = model.value
            widths = np.asarray(x.value_lengths().drop_null())
            if (widths != m.stride).any():
                raise EngineError("batch_shape", f"{int(widths[widths != m.stride][0])} values do not make whole rows of {m.stride}")
            y = m.predict(flat)
            offsets = np.zeros(batch.num_rows + 1, np.int32)
            offsets[1:][there] = m.output_count
            made = pa.ListArray.from_arrays(pa.array(np.cumsum(offsets, dtype=np.int32)), pa.array(y), mask=pa.array(np.asarray(x.is_null())))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], made], names=[*[f.name for f in kept], outputs])

    return source.mapInArrow(run, schema)


def activation_columns(export: dict, inputs: Column, precise: bool = True) -> list[Column]:
    """A small network as one column for each output, evaluated by Spark; ``precise``: in double precision, else every value
    is rounded to single precision. For large networks use ``score``."""
    kind = "double" if precise else "float"
    compiled(export)
    by_uuid = {x["uuid"]: x for x in export["neurons"]}
    incoming: dict[str, list[dict]] = {}
    for s in export["synapses"]:
        incoming.setdefault(s["toUUID"], []).append(s)
    held: dict[str, Column] = {}

    def value(uuid: str) -> Column:
        if found := _INPUT.fullmatch(uuid):
            return F.element_at(first_inputs(inputs, export["input"]), int(found[1]) + 1).cast(kind)
        if uuid not in held:
            total = F.lit(by_uuid[uuid]["bias"]).cast(kind)
            for s in incoming.get(uuid, []):
                total = total + (value(s["fromUUID"]) * F.lit(s["weight"]).cast(kind)).cast(kind)
            held[uuid] = COLUMN_SQUASHES[by_uuid[uuid]["squash"]](total).cast(kind)
        return held[uuid]

    return [value(x["uuid"]) for x in export["neurons"] if x["type"] == "output"]
