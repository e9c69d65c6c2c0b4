"""A project: where its tables are, and the rules of the operators that its stages use.

Each operator owns its rules, in its own units (milliseconds, decibels); a project only names those that differ from
the defaults. In JSON a section has the name of the stage: ``{"name": "p", "out_root": "s3a://x/p", "group": {"max_gap": 3000}}``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace
from importlib import import_module
from pathlib import Path

from cadenza.operators.audio import Slicing
from cadenza.operators.events import Cutting
from cadenza.operators.export import Limits
from cadenza.operators.grouping import Packing
from cadenza.operators.levels import Loudness
from cadenza.operators.silence import Pauses
from cadenza.operators.vectors import Purity

STAGE_RULES = {"group": Packing, "export": Limits, "silence": Pauses, "speaker": Purity, "nonspeech": Cutting, "loudness": Loudness, "audio": Slicing}


@dataclass(frozen=True)
class Project:
    name: str
    out_root: str = ""
    prefix: str = "s"
    speaker: str = "one speaker"
    rules: dict = field(default_factory=dict)
    #: Makers of models by name, each as ``package.module:name``.
    models: dict = field(default_factory=dict)

    def of(self, stage: str):
        """The rules of a stage."""
        return self.rules.get(stage) or STAGE_RULES[stage]()

    def slicing(self) -> Slicing:
        """How clips are cut; pauses are pressed and pieces joined as the export plans it."""
        limits = self.of("export")
        return replace(self.of("audio"), gap_s=limits.max_gap_ms / 1000, gap_share=limits.pass_ratio, join_s=limits.xfade_ms / 1000)

    def makers(self) -> dict:
        """The models' makers, imported."""
        out = {}
        for name, where in self.models.items():
            module, _, attribute = where.partition(":")
            out[name] = getattr(import_module(module), attribute)
        return out


def parse_project(text: str) -> Project:
    """A project from its JSON; an unknown setting is an error."""
    given, own, rules = json.loads(text), {}, {}
    for key, value in given.items():
        if key in STAGE_RULES:
            if unknown := value.keys() - {f.name for f in fields(STAGE_RULES[key])}:
                raise TypeError(f"unknown settings of {key}: {sorted(unknown)}")
            rules[key] = STAGE_RULES[key](**value)
        elif key in ("name", "out_root", "prefix", "speaker", "models"):
            own[key] = value
        else:
            raise TypeError(f"unknown setting: {key}")
    return Project(**own, rules=rules)


def list_projects(folder: str) -> list[str]:
    """The names of the project files of a folder."""
    return sorted(p.stem for p in Path(folder).glob("*.json"))
