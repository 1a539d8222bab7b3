"""Files through pyarrow's file systems, JSON documents with declared fields, and the faults that both raise."""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow.fs as pafs

FAULTS = ("io", "json", "schema", "corrupt", "hash", "semantics")


class ArchiveError(Exception):
    """A refused archive; ``kind`` is one of FAULTS, ``path`` names the file at fault."""

    def __init__(self, kind: str, path: str, detail: str):
        super().__init__(kind, path, detail)
        self.kind, self.path, self.detail = kind, path, detail

    def __str__(self) -> str:
        return f"archive {self.kind} fault at {self.path}: {self.detail}"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The store that a path or URI lies in, and the path within it."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def read_bytes(path: str) -> bytes:
    """The whole file; OSError if it can't be read."""
    fs, at = file_system(path)
    with fs.open_input_stream(at, compression=None) as source:
        return source.read()


def write_bytes(path: str, data: bytes) -> None:
    fs, at = file_system(path)
    with fs.open_output_stream(at, compression=None) as out:
        out.write(data)


def pretty(value: dict) -> bytes:
    return (json.dumps(value, indent=2, ensure_ascii=False) + "\n").encode()


@dataclass(frozen=True)
class Field:
    """A field of a JSON object: text, whole number (up to ``most``) or list of objects."""

    name: str
    kind: type
    most: int = (1 << 64) - 1
    optional: bool = False
    of: tuple[Field, ...] = ()


def checked(value, fields: tuple[Field, ...], where: str = "") -> dict:
    """The declared fields of an object; ValueError if one is missing, twice or of another kind. Others are ignored."""
    if not isinstance(value, dict):
        raise ValueError(f"{where or 'the document'} is not an object")
    out = {}
    for f in fields:
        found, name = value.get(f.name), f"{where}{f.name}"
        if found is None and f.optional:
            out[f.name] = None
        elif f.name not in value:
            raise ValueError(f"missing field {name}")
        elif f.kind is int and (type(found) is not int or not 0 <= found <= f.most) or f.kind is not int and not isinstance(found, f.kind):
            raise ValueError(f"field {name} has another type or range")
        else:
            out[f.name] = [checked(x, f.of, f"{name}.") for x in found] if f.kind is list else found
    return out


def _once(known: frozenset[str]):
    def build(pairs: list[tuple]) -> dict:
        made = dict(pairs)
        if len(made) < len(pairs) and (twice := [k for k in made if k in known and sum(k == x for x, _ in pairs) > 1]):
            raise ValueError(f"duplicate field {twice[0]}")
        return made

    return build


def _names(fields: tuple[Field, ...]) -> frozenset[str]:
    return frozenset(f.name for f in fields).union(*[_names(f.of) for f in fields]) if fields else frozenset()


def _columns(found: dict, fields: tuple[Field, ...], name: str) -> dict | None:
    """The fields of an object, the list ``name`` as a list for each of its fields; None unless all are plainly of their kinds."""
    own = next(f for f in fields if f.name == name)
    rows = found.get(name)
    if type(rows) is not list or not {type(r) for r in rows} <= {dict}:
        return None
    made = {}
    for f in own.of:
        made[f.name] = values = [r.get(f.name) for r in rows]
        if not {type(v) for v in values} <= ({f.kind, type(None)} if f.optional else {f.kind}) or f.kind is int and values and not 0 <= min(values) <= max(values) < 1 << 63:
            return None
    return {**checked({**found, name: []}, fields), name: made}


def read_json(path: str, fields: tuple[Field, ...], columns: str | None = None) -> dict:
    """A JSON document; an ``io`` fault if it can't be read as text, a ``json`` fault if it lacks the declared form. The list that
    ``columns`` names, of many objects, comes out as a list for each of their fields."""
    try:
        text = read_bytes(path).decode()
    except (OSError, UnicodeDecodeError) as e:
        raise ArchiveError("io", path, str(e)) from None
    try:
        found = json.loads(text, object_pairs_hook=_once(_names(fields)))
        if columns is None:
            return checked(found, fields)
        if isinstance(found, dict) and (made := _columns(found, fields, columns)) is not None:
            return made
        found = checked(found, fields)
        return {**found, columns: {f.name: [r[f.name] for r in found[columns]] for f in next(f for f in fields if f.name == columns).of}}
    except (ValueError, RecursionError) as e:
        raise ArchiveError("json", path, str(e)) from None
