"""What one run works on: versions, institutions and provenance."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from typing import Any

ALL_YEARS = 1


class ConfigError(ValueError):
    """Every problem found in a configuration, reported together."""


def _version_problem(name: str, value: Any) -> str | None:
    if not value:
        return f"{name} is missing"
    try:
        datetime.strptime(str(value), "%Y%m%d")
    except ValueError:
        return f"{name} is not a YYYYMMDD date: {value!r}"
    return None


@dataclass(frozen=True)
class Institution:
    """One institution's input tables and publication-year cutoff."""

    institution_id: str
    dois_table: str
    oddpub_table: str
    trials_table: str
    year_cutoff: int = ALL_YEARS

    @classmethod
    def from_mapping(cls, values: Mapping[str, Any]) -> Institution:
        required = {
            "institution_id": "institution_id",
            "dois_table": "dois_table_name",
            "oddpub_table": "oddpub_table_name",
            "trials_table": "trials_aact_table_name",
        }
        missing = [key for key in required.values() if not values.get(key)]
        if missing:
            raise ConfigError("\n".join(f"institution lacks {key}" for key in missing))
        given = {field: str(values[key]) for field, key in required.items()}
        cutoff = values.get("year_cutoff", ALL_YEARS)
        try:
            return cls(**given, year_cutoff=int(cutoff))
        except (TypeError, ValueError):
            raise ConfigError(f"{given['institution_id']}: year_cutoff is not a year: {cutoff!r}") from None

    @property
    def input_database(self) -> str:
        return f"{self.institution_id}_from_partners"

    @property
    def output_database(self) -> str:
        return f"{self.institution_id}_data"

    @property
    def latest_database(self) -> str:
        return f"{self.institution_id}_data_latest"


@dataclass(frozen=True)
class Run:
    """Versions of one run over one or more institutions."""

    run_version: str
    doi_version: str
    workflow_version: str
    institutions: tuple[Institution, ...]

    @classmethod
    def from_mapping(cls, values: Mapping[str, Any], workflow_version: str) -> Run:
        context = values.get("context") or {}
        problems = [
            _version_problem("run_version", context.get("run_version")),
            _version_problem("doi_version", context.get("doi_version")),
            None if context else "no context given",
            None if values.get("partners") else "no institutions given",
        ]
        institutions = []
        for entry in values.get("partners") or ():
            try:
                institutions.append(Institution.from_mapping(entry))
            except ConfigError as error:
                problems.append(str(error))
        found = [problem for problem in problems if problem]
        if found:
            raise ConfigError("\n".join(found))
        return cls(
            run_version=str(context["run_version"]),
            doi_version=str(context["doi_version"]),
            workflow_version=workflow_version,
            institutions=tuple(institutions),
        )

    @property
    def works_table(self) -> str:
        return f"doi{self.doi_version}"

    def output_table(self, kind: str) -> str:
        return f"{kind}{self.run_version}"


@dataclass(frozen=True)
class Provenance:
    """Constants written into every output row."""

    workflow_version: str
    works_table: str
    dois_table: str
    oddpub_table: str
    trials_table: str
    institution_id: str

    @classmethod
    def of(cls, run: Run, institution: Institution) -> Provenance:
        return cls(
            workflow_version=run.workflow_version,
            works_table=run.works_table,
            dois_table=institution.dois_table,
            oddpub_table=institution.oddpub_table,
            trials_table=institution.trials_table,
            institution_id=institution.institution_id,
        )
