"""File contracts: what columns a source file has and which rules each column obeys.

A contract is read once on the driver and compiled into Spark schemas and Column expressions;
no contract object ever reaches an executor.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

SPARK_TYPES: dict[str, T.DataType] = {
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "varchar": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class ForeignKey:
    column: str
    ref_column: str
    ref_table: str


@dataclass(frozen=True)
class ColumnRule:
    name: str
    type: str = "varchar"
    pk: bool = False
    nullable: bool = True
    pii: bool = False
    format: str | None = None
    expected_values: tuple[str, ...] = ()
    minimum: float | None = None
    maximum: float | None = None
    fk: ForeignKey | None = None

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES.get(self.type, T.StringType())

    @property
    def has_range(self) -> bool:
        return self.minimum is not None or self.maximum is not None

    @classmethod
    def from_mapping(cls, spec: Mapping) -> ColumnRule:
        fk, limits = spec.get("fk"), spec.get("range") or {}
        target = None
        if fk:
            # the target may be a lookup file, a dimension or a fact
            target = fk.get("target_table") or fk.get("target_dimension") or fk.get("target_fact")
        return cls(
            name=spec["name"],
            type=spec.get("type", "varchar"),
            pk=bool(spec.get("pk", False)),
            nullable=bool(spec.get("nullable", True)),
            pii=bool(spec.get("pii", False)),
            format=spec.get("format"),
            expected_values=tuple(str(v) for v in spec.get("expected_values") or ()),
            minimum=limits.get("min"),
            maximum=limits.get("max"),
            fk=ForeignKey(spec["name"], fk["pk"], target) if fk else None,
        )


@dataclass(frozen=True)
class FileContract:
    file_name: str
    columns: tuple[ColumnRule, ...]
    section: str = "batch"
    target_dimension: str | None = None
    target_fact: str | None = None
    write_priority: int = 0

    @property
    def stem(self) -> str:
        return self.file_name.rsplit(".", 1)[0]

    @property
    def silver_table(self) -> str:
        return f"silver_{self.stem}"

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def primary_keys(self) -> list[str]:
        return [c.name for c in self.columns if c.pk]

    @property
    def foreign_keys(self) -> list[ForeignKey]:
        return [c.fk for c in self.columns if c.fk]

    @property
    def pii_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.pii]

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    @property
    def types(self) -> dict[str, str]:
        return {c.name: c.type for c in self.columns}

    @property
    def formats(self) -> dict[str, str]:
        return {c.name: c.format for c in self.columns if c.format}

    @property
    def ranges(self) -> dict[str, tuple[float | None, float | None]]:
        return {c.name: (c.minimum, c.maximum) for c in self.columns if c.has_range}

    @property
    def enums(self) -> dict[str, tuple[str, ...]]:
        return {c.name: c.expected_values for c in self.columns if c.expected_values}

    def columns_of(self, *types: str) -> list[str]:
        return [c.name for c in self.columns if c.type in types]

    def read_schema(self, extra: Iterable[str] = ()) -> T.StructType:
        """All-string schema: text is read as written and cast by the row rules, never inferred."""
        return T.StructType([T.StructField(n, T.StringType()) for n in [*self.names, *extra]])

    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type) for c in self.columns])

    def column(self, name: str) -> ColumnRule:
        return next(c for c in self.columns if c.name == name)

    @classmethod
    def from_mapping(cls, spec: Mapping, section: str = "batch") -> FileContract:
        return cls(
            file_name=spec["file_name"],
            columns=tuple(ColumnRule.from_mapping(c) for c in spec.get("columns", [])),
            section=section,
            target_dimension=spec.get("target_dimension"),
            target_fact=spec.get("target_fact"),
            write_priority=int(spec.get("write_priority") or 0),
        )


@dataclass
class ContractBook:
    """All contracts of one deployment, looked up by file stem so a file may be CSV or JSON."""

    contracts: list[FileContract] = field(default_factory=list)

    @classmethod
    def from_mapping(cls, spec: Mapping) -> ContractBook:
        return cls([
            FileContract.from_mapping(entry, section)
            for section in ("batch", "stream")
            for entry in spec.get(section) or []
        ])

    @classmethod
    def from_yaml(cls, path: str) -> ContractBook:
        try:
            import yaml
        except ImportError as exc:  # contracts can also be given as a mapping
            raise RuntimeError("reading a YAML contract needs PyYAML") from exc
        with open(path, encoding="utf-8") as handle:
            return cls.from_mapping(yaml.safe_load(handle) or {})

    def section(self, name: str) -> list[FileContract]:
        """``batch``, ``stream``, or ``master``: lookup files, which are declared under batch."""
        if name == "master":
            return [c for c in self.contracts
                    if c.section == "batch" and c.target_dimension is None]
        chosen = [c for c in self.contracts if c.section == name]
        return sorted(chosen, key=lambda c: c.write_priority)

    def section_for(self, file_name: str) -> str | None:
        found = self.find(file_name)
        return found.section if found else None

    def file_name_for(self, stem: str) -> str:
        found = self.find(stem)
        return found.file_name if found else f"{stem}.csv"

    def find(self, file_name: str) -> FileContract | None:
        stem = file_name.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        return next((c for c in self.contracts if c.stem == stem), None)

    def __getitem__(self, file_name: str) -> FileContract:
        found = self.find(file_name)
        if found is None:
            raise KeyError(f"no contract for {file_name}")
        return found

    @property
    def file_names(self) -> list[str]:
        return [c.file_name for c in self.contracts]
