"""Schema documents and the catalogue that finds them by path."""

from __future__ import annotations

import json
from pathlib import Path

FOLDER = Path(__file__).parent
JSON_SUFFIX, AVRO_SUFFIX = ".json", ".avsc"


def load_document(path: str | Path) -> dict:
    """Read one JSON Schema or Avro document; a missing file raises ``FileNotFoundError``."""
    return json.loads(Path(path).read_text(encoding="utf-8"))


def builtin(name: str) -> dict:
    """A document shipped with the package, by file name."""
    return load_document(FOLDER / name)


def builtin_names() -> list[str]:
    return sorted(p.name for p in FOLDER.iterdir() if p.suffix in (JSON_SUFFIX, AVRO_SUFFIX))


def load_catalogue(paths: dict[str, str | Path]) -> dict[str, dict]:
    """Documents by the ``schema_path`` that messages carry, read once per job on the driver.

    ``paths`` maps a message's ``schema_path`` to the file to read. A file that is missing or is
    not a JSON object is left out, so that messages naming it count as invalid rather than
    failing the job.
    """
    documents = {}
    for schema_path, file in paths.items():
        try:
            document = load_document(file)
        except (FileNotFoundError, json.JSONDecodeError):
            continue
        if isinstance(document, dict):
            documents[schema_path] = document
    return documents
