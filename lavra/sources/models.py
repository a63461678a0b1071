"""Local model files for encoders: which file to load, and how its output is pooled. Nothing is downloaded."""

from __future__ import annotations

import json
from pathlib import Path


def find_model(model: str, onnx_file: str, cache: str | None = None) -> Path:
    """The model's folder, given directly or found by name in a cache; its data file may lie beside it.

    A missing file is an error that names the files that are there.
    """
    places = [Path(model)] + ([Path(cache) / model, Path(cache) / model.replace("/", "--")] if cache else [])
    folder = next((p for p in places if p.is_dir()), None)
    if folder is None:
        raise FileNotFoundError(f"no folder of model {model!r} in {[str(p) for p in places]}")
    if not (folder / onnx_file).is_file():
        there = sorted(str(p.relative_to(folder)) for p in folder.rglob("*.onnx"))
        raise FileNotFoundError(f"{onnx_file!r} is not in {folder}; there are: {', '.join(there) or 'no model files'}")
    return folder


def pooling_of(folder: Path) -> str | None:
    """cls or mean, from the pooling configuration beside the model; None without one."""
    path = Path(folder) / "1_Pooling" / "config.json"
    if not path.is_file():
        return None
    config = json.loads(path.read_text(encoding="utf-8"))
    if config.get("pooling_mode_cls_token"):
        return "cls"
    return "mean" if config.get("pooling_mode_mean_tokens") else None
