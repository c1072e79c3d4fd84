"""The built-in annotation layers, registered under their names: rows (kind, data, seq) from tables of records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..functions.descriptors import clean_sequence, composition
from ..operators import features, records
from . import plugins

#: Database names of cross-references by layer.
REFERENCES = {"go": "GO", "reactome": "Reactome", "interpro": "InterPro", "pdb": "PDB"}


def as_rows(df: DataFrame, kind: str) -> DataFrame:
    """Rows of a kind: each column with a value as text (nested ones as JSON), and a seq that follows the order of partitions."""
    nested = (ArrayType, MapType, StructType)
    text = lambda f: F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`").cast("string")
    data = F.create_map(*(x for f in df.schema.fields for x in (F.lit(f.name), text(f))))
    return df.select(F.lit(kind).alias("kind"), F.map_filter(data, lambda k, v: v.isNotNull() & (F.trim(v) != "")).alias("data"), F.monotonically_increasing_id().alias("seq"))


@dataclass
class BuiltIn:
    """A layer that is enabled if the setting ``layers`` names it (or is missing), and reads the tables ``needs``."""

    name: str
    needs: tuple[str, ...]
    make: Callable[..., DataFrame]

    def enabled(self, settings: dict) -> bool:
        return "layers" not in settings or self.name in settings["layers"]

    def rows(self, spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
        missing = [t for t in self.needs if t not in tables]
        if missing:
            raise KeyError(f"layer {self.name} needs the tables {', '.join(missing)}")
        return as_rows(self.make(*(tables[t] for t in self.needs)), self.name)


def _compositions(proteins: DataFrame) -> DataFrame:
    """Composition vectors of protein sequences as embeddings."""
    cleaned = proteins.select("protein_id", clean_sequence("sequence").alias("sequence")).filter("sequence != ''")
    shares = [c for name, c in composition(F.col("sequence")).items() if name.startswith("freq_")]
    return cleaned.select("protein_id", F.lit("aa_composition_v1").alias("method"), F.array(*shares).alias("embedding"))


def _registered() -> None:
    """``protein_records(protein_id, record)``, ``structure_records``, ``molecules``, ``affinity_records``, ``affinity_file``, ``drug_file``, ``properties`` and ``synonyms`` are
    tables of records as the sources give them; ``compounds`` and ``proteins`` are the graph's."""
    proteins = records.protein_records
    made: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
        "uniprot": (("protein_records",), lambda r: proteins(r).drop("xrefs")),
        **{name: (("protein_records",), lambda r, db=db: records.xref_rows(proteins(r), db)) for name, db in REFERENCES.items()},
        "alphafold": (("proteins", "structure_records"), records.structure_models),
        "chembl": (("compounds", "molecules"), records.molecules_by_key),
        "bindingdb": (("affinity_records",), records.affinity_rows),
        "bindingdb_file": (("affinity_file", "compounds", "proteins"), lambda r, c, p: records.imported(r, c, p, "bindingdb_id", "BindingDB")),
        "drugbank": (("drug_file", "compounds", "proteins"), lambda r, c, p: records.drug_rows(r, c, p, "local import")),
        "pubchem": (("compounds", "properties", "synonyms"), records.compound_records),
        "molgraph": (("compounds",), lambda c: features.descriptor_rows(c, "cid", "formula", "smiles")),
        "protembed": (("proteins",), _compositions),
    }
    for name, (needs, make) in made.items():
        plugins.register(name)(lambda name=name, needs=needs, make=make: BuiltIn(name, needs, make))


_registered()
LAYERS = [name for name in plugins.REGISTRY if isinstance(plugins.REGISTRY[name](), BuiltIn)]


def layer_rows(spark: SparkSession, tables: dict[str, DataFrame], layers: list[str] | None = None) -> tuple[DataFrame | None, dict[str, str]]:
    """The rows of the named built-in layers (all by default), one after another, and what became of each: a layer whose tables are missing
    fails with a warning and the others go on."""
    found: list[DataFrame] = []
    chosen = plugins.load(LAYERS if layers is None else layers)
    status = plugins.apply(chosen, spark, tables, {}, lambda name, rows: found.append(rows))
    out = None
    for rows in found:
        out = rows if out is None else out.unionByName(rows)
    return out, status
