"""Domain definitions: read, brought to one form, verified, and turned into Spark schemas and documents."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALARS = {"string": T.StringType(), "number": T.DoubleType(), "integer": T.LongType(), "boolean": T.BooleanType(), "object": T.VariantType()}
KINDS = ("choice", "score", "boolean")


class DomainError(ValueError):
    """Everything that is wrong with a domain definition."""


def load_definition(source: str | dict) -> dict:
    """A definition from a mapping, a JSON file or, where yaml is installed, a YAML file."""
    if isinstance(source, dict):
        return source
    text = Path(source).read_text(encoding="utf-8")
    if source.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading YAML needs the yaml package") from error
        return yaml.safe_load(text)
    return json.loads(text)


def _attribute(name: str, spec: str | dict) -> dict:
    spec = {"type": spec} if isinstance(spec, str) else dict(spec)
    return {"name": name, "type": spec.get("type", "string"), "items": spec.get("items", "string"), "required": bool(spec.get("required", False))}


def build_ir(definition: dict) -> dict:
    """One form for short and long notations: entities with attributes and relationships, decisions with questions."""
    entities = []
    for name, spec in (definition.get("entities") or {}).items():
        spec = spec or {}
        attributes = [_attribute(n, a) for n, a in (spec.get("attributes") or {}).items()]
        relations = [{"name": n, "target": r if isinstance(r, str) else r.get("target")} for n, r in (spec.get("relationships") or {}).items()]
        entities.append({"name": name, "attributes": attributes, "relationships": relations})
    decisions = []
    for name, spec in (definition.get("decisions") or {}).items():
        questions = spec.get("questions") or [{k: spec[k] for k in ("id", "kind", "options") if k in spec}]
        decisions.append({"name": name, "threshold": spec.get("threshold", 0.5), "questions": [{"id": q.get("id", name), "kind": q.get("kind", "choice"), "options": list(q.get("options") or [])} for q in questions]})
    together = lambda key: sorted(set(definition.get(key) or []))
    return {"domain": definition.get("domain"), "version": str(definition.get("version", "1.0")), "entities": entities, "decisions": decisions, "policies": together("policies"), "capabilities": together("capabilities")}


def verify(ir: dict) -> list[str]:
    """All errors of a domain: names given twice, unknown targets, kinds and thresholds that can't be."""
    errors = [] if ir["domain"] else ["domain has no name"]
    names = [e["name"] for e in ir["entities"]]
    errors += [f"entity {n} is given twice" for n in sorted({n for n in names if names.count(n) > 1})]
    for e in ir["entities"]:
        own = [a["name"] for a in e["attributes"]]
        errors += [f"{e['name']}.{n} is given twice" for n in sorted({n for n in own if own.count(n) > 1})]
        errors += [f"{e['name']}.{r['name']} leads to unknown {r['target']}" for r in e["relationships"] if r["target"] not in names]
    seen: set[str] = set()
    for d in ir["decisions"]:
        if isinstance(d["threshold"], bool) or not isinstance(d["threshold"], (int, float)) or not 0 <= d["threshold"] <= 1:
            errors.append(f"{d['name']} has a threshold outside of 0 to 1")
        for q in d["questions"]:
            errors += [f"question {q['id']} is given twice"] * (q["id"] in seen)
            seen.add(q["id"])
            errors += [f"question {q['id']} has unknown kind {q['kind']}"] * (q["kind"] not in KINDS)
            errors += [f"question {q['id']} is a choice without options"] * (q["kind"] == "choice" and not q["options"])
    return errors


def spark_schema(entity: dict) -> T.StructType:
    """The Spark schema of an entity; types that Spark lacks become strings that remember what was declared."""
    fields = []
    for a in entity["attributes"]:
        if a["type"] == "array":
            kind = T.ArrayType(SCALARS.get(a["items"], T.StringType()))
        else:
            kind = SCALARS.get(a["type"], T.StringType())
        known = a["type"] in SCALARS or a["type"] == "array"
        fields.append(T.StructField(a["name"], kind, not a["required"], {} if known else {"declared": a["type"]}))
    return T.StructType(fields)


def required_checks(entity: dict) -> dict[str, Column]:
    """Null checks of the required attributes, for violations.rows_failing."""
    return {f"{a['name']} is given": F.col(a["name"]).isNotNull() for a in entity["attributes"] if a["required"]}


def compile_domain(source: str | dict, output: str) -> dict:
    """Verify a domain and write its schemas, its form and a manifest; all errors are raised together."""
    definition = load_definition(source)
    ir = build_ir(definition)
    if errors := verify(ir):
        raise DomainError("; ".join(errors))
    root = Path(output)
    (root / "schemas").mkdir(parents=True, exist_ok=True)
    for e in ir["entities"]:
        (root / "schemas" / f"{e['name']}.json").write_text(spark_schema(e).json())
    (root / "domain.json").write_text(json.dumps(ir, sort_keys=True, indent=1))
    raw = json.dumps(definition, sort_keys=True) if isinstance(source, dict) else Path(source).read_text(encoding="utf-8")
    manifest = {"domain": ir["domain"], "version": ir["version"], "definition_sha256": hashlib.sha256(raw.encode()).hexdigest(), "files": sorted(p.relative_to(root).as_posix() for p in root.rglob("*.json") if p.name != "manifest.json")}
    (root / "manifest.json").write_text(json.dumps(manifest, sort_keys=True))
    return manifest
