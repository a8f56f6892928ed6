"""Run configuration (retailers, level counts, allow/deny lists, replacements).

Same keys as the YAML file of the original notebooks:

    retailer:
      <name>: {nb_levels: int, level0: [...], level1_to_delete: [...]}
    unknown_brands: [...]
    slug_replacements: [[old, new], ...]
    classification_levels: ['0', '1', '2']
    classification_most_relevant_level: 2

The lists are small and fixed by the run, so they are used as ``isin`` literal
sets (pushed to the parquet scan as ``In`` filters).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RetailerConfig:
    name: str
    nb_levels: int
    level0: tuple[str, ...]
    level1_to_delete: tuple[str, ...] = ()


@dataclass(frozen=True)
class Config:
    retailers: tuple[RetailerConfig, ...]
    unknown_brands: tuple[str, ...] = ()
    slug_replacements: tuple[tuple[str, str], ...] = (("&", "et"),)
    classification_levels: tuple[int, ...] = (0, 1, 2)
    classification_most_relevant_level: int = 2
    # Retailers whose category columns are left out of the category features
    # (the notebooks drop the third catalogue's levels); by position.
    exclude_retailers: tuple[int, ...] = ()
    extra: dict = field(default_factory=dict)

    @property
    def retailer_names(self) -> list[str]:
        return [r.name for r in self.retailers]

    @property
    def max_levels(self) -> int:
        return max(r.nb_levels for r in self.retailers)

    def retailer(self, name: str) -> RetailerConfig:
        for r in self.retailers:
            if r.name == name:
                return r
        raise KeyError(name)

    @classmethod
    def from_dict(cls, d: dict) -> "Config":
        rets = tuple(
            RetailerConfig(
                name=name,
                nb_levels=int(v["nb_levels"]),
                level0=tuple(v.get("level0", ())),
                level1_to_delete=tuple(v.get("level1_to_delete", ())),
            )
            for name, v in d["retailer"].items()
        )
        return cls(
            retailers=rets,
            unknown_brands=tuple(d.get("unknown_brands", ())),
            slug_replacements=tuple(tuple(p) for p in d.get("slug_replacements", [["&", "et"]])),
            classification_levels=tuple(int(x) for x in d.get("classification_levels", (0, 1, 2))),
            classification_most_relevant_level=int(d.get("classification_most_relevant_level", 2)),
            exclude_retailers=tuple(d.get("exclude_retailers", ())),
        )

    @classmethod
    def from_yaml(cls, path: str) -> "Config":
        import yaml

        with open(path, "r") as fh:
            return cls.from_dict(yaml.safe_load(fh))


# Configuration of the driver-table fixture catalogue (FIXTURES.md): three
# retailers with three levels each, every part type allowed except PROMO,
# level1 "OLD" denied, placeholder brands "NO NAME" and the empty slug.
FIXTURE_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")

FIXTURE_CONFIG = Config(
    retailers=(
        RetailerConfig("north", 3, FIXTURE_TYPES, ("OLD",)),
        RetailerConfig("south", 3, FIXTURE_TYPES, ("OLD",)),
        RetailerConfig("east", 3, FIXTURE_TYPES, ("OLD",)),
    ),
    unknown_brands=("NO NAME", ""),
    slug_replacements=(("&", "et"),),
    classification_levels=(0, 1, 2),
    classification_most_relevant_level=2,
    exclude_retailers=(2,),
)
