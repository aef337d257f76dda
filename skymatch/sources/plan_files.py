"""The plan of a transform from YAML files: projection, packed flags, rename rules and names of a database's columns.

Everything is checked when a file is loaded, so that a wrong file stops a job before Spark starts. Formats:

projection      ``funcs``: output column -> ``functor`` and ``args`` (a name, a list of names, or nothing)
flags           documents with ``tableName`` and ``columns``: each a ``columnName`` and a ``bitList`` of ``name`` and ``bit``
rename rules    ``flag_rename_rules``: pairs of a prefix and what stands for it, in order
names           table -> name in the database -> name in raw catalogs
"""

from __future__ import annotations

import inspect
import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

import yaml
from pyspark.sql import Column, DataFrame

from ..functions import flags, photometry

#: Bits of a long that a flag can have; the last is its sign.
MOST_BITS = 63


class _Strict(yaml.SafeLoader):
    """Refuses a key that stands twice, of which one would be lost."""

    def construct_mapping(self, node: yaml.MappingNode, deep: bool = False) -> dict:
        names = [self.construct_object(k, deep=True) for k, _ in node.value]
        if twice := sorted({str(n) for n in names if names.count(n) > 1}):
            raise ValueError(f"{node.start_mark.name}, line {node.start_mark.line + 1}: {', '.join(twice)} more than once")
        return super().construct_mapping(node, deep)


def _documents(path: str) -> list[Any]:
    with open(os.path.expandvars(path), encoding="utf-8") as file:
        return [d for d in yaml.load_all(file, _Strict) if d is not None]


def _section(path: str, key: str) -> list[Any]:
    found = [d[key] for d in _documents(path) if isinstance(d, dict) and key in d]
    if not found:
        raise ValueError(f"{path} has no {key}")
    return found


def load_projection(path: str, functors: Mapping[str, Callable[..., Column]] | None = None) -> list[tuple[str, str, tuple[str, ...]]]:
    """Output, functor and arguments of every column, in the file's order, as :func:`~skymatch.functions.photometry.projection` takes them."""
    known, out = functors or photometry.FUNCTORS, []
    for output, entry in (item for part in _section(path, "funcs") for item in part.items()):
        entry = {} if entry is None else entry
        if not isinstance(entry, dict) or "functor" not in entry:
            raise ValueError(f"{path}: {output} has no functor")
        name, args = entry["functor"], entry.get("args")
        args = () if args is None else (args,) if isinstance(args, str) else tuple(args)
        if name not in known:
            raise ValueError(f"{path}: {output} asks for the functor {name}, which is not known")
        if bad := [a for a in args if not isinstance(a, str)]:
            raise ValueError(f"{path}: {output} has arguments that are no names: {bad}")
        # Spark's own functions take any number of arguments.
        try:
            inspect.signature(known[name]).bind(*args)
        except TypeError as e:
            raise ValueError(f"{path}: {output}, {name}: {e}") from None
        out.append((output, name, args))
    outputs = [o for o, _, _ in out]
    if twice := sorted({o for o in outputs if outputs.count(o) > 1}):
        raise ValueError(f"{path}: {', '.join(twice)} more than once")
    return out


def load_flags(path: str, table: str = "DiaSource") -> dict[str, dict[str, int]]:
    """Flags and their bits for every packed column of a table; none if the file doesn't name the table."""
    layout: dict[str, dict[str, int]] = {}
    for document in (d for d in _documents(path) if isinstance(d, dict) and d.get("tableName") == table):
        for column in document.get("columns", ()):
            bits: dict[str, int] = {}
            for entry in column["bitList"]:
                name, bit = entry["name"], entry["bit"]
                if isinstance(bit, bool) or not isinstance(bit, int) or not 0 <= bit < MOST_BITS:
                    raise ValueError(f"{path}: the bit of {name} is {bit}, not one of 0 to {MOST_BITS - 1}")
                if name in bits or bit in bits.values():
                    raise ValueError(f"{path}: {name} or bit {bit} stands twice in {column['columnName']}")
                bits[name] = bit
            if column["columnName"] in layout:
                raise ValueError(f"{path}: {column['columnName']} more than once")
            layout[column["columnName"]] = bits
    return layout


def load_renames(path: str) -> dict[str, str]:
    """Prefixes and what stands for them, in order. A prefix after a shorter one that covers it could never be used, and is an error."""
    rules: dict[str, str] = {}
    for rule in (r for part in _section(path, "flag_rename_rules") for r in part):
        if not isinstance(rule, list) or len(rule) != 2 or not all(isinstance(x, str) for x in rule):
            raise ValueError(f"{path}: {rule} is no pair of a prefix and a name")
        if hidden := [old for old in rules if rule[0].startswith(old)]:
            raise ValueError(f"{path}: {rule[0]} comes after {hidden[0]}, which covers it")
        rules[rule[0]] = rule[1]
    return rules


@dataclass(frozen=True)
class ColumnNames:
    """Names of a table's columns in the database and in raw catalogs; names that are not listed are the same in both."""

    to_raw: Mapping[str, str]

    def __post_init__(self):
        raw = list(self.to_raw.values())
        if twice := sorted({r for r in raw if raw.count(r) > 1}):
            raise ValueError(f"{', '.join(twice)} stands for more than one column")

    def raw(self, df: DataFrame) -> DataFrame:
        return _renamed(df, self.to_raw)

    def database(self, df: DataFrame) -> DataFrame:
        return _renamed(df, {r: d for d, r in self.to_raw.items()})


def _renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    after = [names.get(c, c) for c in df.columns]
    if twice := sorted({c for c in after if after.count(c) > 1}):
        raise ValueError(f"{', '.join(twice)} would stand twice")
    return df.toDF(*after)


def load_names(path: str) -> dict[str, ColumnNames]:
    """The names of every table of a file."""
    out: dict[str, ColumnNames] = {}
    for document in _documents(path):
        for table, names in document.items():
            if table in out or not isinstance(names, dict) or not all(isinstance(x, str) for pair in names.items() for x in pair):
                raise ValueError(f"{path}: {table} stands twice or is no list of names")
            out[table] = ColumnNames(names)
    return out


@dataclass(frozen=True)
class Plan:
    """What :func:`~skymatch.operators.detections.transform` does to a raw catalog; by default the library's own tables."""

    projection: list[tuple[str, str, tuple[str, ...]]] = field(default_factory=lambda: list(photometry.PROJECTION))
    layout: Mapping[str, Mapping[str, int]] = field(default_factory=lambda: {"flags": flags.FLAG_BITS})
    renames: Mapping[str, str] = field(default_factory=lambda: dict(flags.RENAMES))

    @classmethod
    def load(cls, projection: str | None = None, flag_map: str | None = None, rename_rules: str | None = None, table: str = "DiaSource") -> Plan:
        """A plan from files; what has no file keeps its default."""
        given: dict[str, Any] = {}
        if projection is not None:
            given["projection"] = load_projection(projection)
        if flag_map is not None:
            given["layout"] = load_flags(flag_map, table)
        if rename_rules is not None:
            given["renames"] = load_renames(rename_rules)
        return cls(**given)

    def save(self, folder: str, table: str = "DiaSource") -> tuple[str, str, str]:
        """Write the plan as three files that :meth:`load` reads, a start for one's own; returns their paths."""
        funcs = {o: {"functor": f} | ({"args": list(a) if len(a) > 1 else a[0]} if a else {}) for o, f, a in self.projection}
        columns = [{"columnName": c, "bitList": [{"name": n, "bit": b} for n, b in bits.items()]} for c, bits in self.layout.items()]
        made = {"projection": {"funcs": funcs}, "flags": {"tableName": table, "columns": columns}, "renames": {"flag_rename_rules": [list(r) for r in self.renames.items()]}}
        os.makedirs(folder, exist_ok=True)
        paths = []
        for name, content in made.items():
            paths.append(os.path.join(folder, f"{name}.yaml"))
            with open(paths[-1], "w", encoding="utf-8") as file:
                yaml.safe_dump(content, file, sort_keys=False, allow_unicode=True)
        return tuple(paths)
