"""Settings of a conversion, from files, dictionaries or the environment."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field, fields, replace
from datetime import date


@dataclass(frozen=True)
class Config:
    """What a conversion extracts and builds; year stands where a document names none, the present one by default."""

    extract_images: bool = True
    extract_tables: bool = True
    preserve_formatting: bool = True
    min_image_size: int = 50
    create_package: bool = True
    output_dir: str = "output"
    year: str = field(default_factory=lambda: str(date.today().year))

    @classmethod
    def from_dict(cls, values: dict) -> Config:
        """Known settings of a dictionary, also one level down in groups; others are left out."""
        flat = dict(values)
        for group in values.values():
            if isinstance(group, dict):
                flat |= group
        names = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in flat.items() if k in names and not isinstance(v, dict)})

    @classmethod
    def from_json(cls, text: str) -> Config:
        return cls.from_dict(json.loads(text))

    @classmethod
    def from_file(cls, path: str) -> Config:
        with open(path, encoding="utf-8") as f:
            return cls.from_json(f.read())

    @classmethod
    def from_env(cls, prefix: str = "FOLIOFRAME_", env: dict[str, str] | None = None) -> Config:
        env, out = os.environ if env is None else env, cls()
        for f in fields(cls):
            if (value := env.get(prefix + f.name.upper())) is not None:
                kind = type(getattr(out, f.name))
                out = replace(out, **{f.name: truth(value) if kind is bool else kind(value)})
        return out

    def to_dict(self) -> dict:
        return asdict(self)

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            json.dump(self.to_dict(), f, indent=2)


def truth(value: str) -> bool:
    return value.strip().lower() in ("true", "1", "yes")
