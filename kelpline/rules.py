"""Sites, their normalisation rules and file name aliases."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SiteRule:
    lower_descriptions: bool = False
    drop_blank_codes: bool = False
    aliases: tuple[str, ...] = ()


# The supported sites and their rules.
PRIMARY_SITES = (
    "Allegheny", "Buncombe", "Charleston", "Cook", "Harris", "Lucas", "Mecklenburg", "Milwaukee",
    "Multnomah", "New Orleans", "Palm Beach", "Pennington", "Pima", "San Francisco", "Spokane", "St. Louis",
)
SECONDARY_SITES = ("Allegheny", "Charleston", "Lucas", "Milwaukee", "New Orleans", "Palm Beach", "San Francisco", "Spokane")
SPECIAL = {
    "Buncombe": SiteRule(drop_blank_codes=True),
    "New Orleans": SiteRule(aliases=("NewOrleans", "New_Orleans")),
    "Palm Beach": SiteRule(aliases=("PalmBeach", "Palm_Beach", "Palm Beach")),
    "San Francisco": SiteRule(aliases=("San Francisco", "San_Francisco", "SanFrancisco")),
    "Spokane": SiteRule(lower_descriptions=True),
    "St. Louis": SiteRule(aliases=("StLouis", "St_Louis")),
}
# Historical column spellings and helper columns of source files.
RENAMES = {"chrg_type_FTA": "chrg_type_fta", "chrg_type_FTC": "chrg_type_ftc"}
DROPPED = ("check",)


def rule_for(site: str) -> SiteRule:
    if site not in PRIMARY_SITES:
        raise ValueError(f"unknown site: {site}")
    return SPECIAL.get(site, SiteRule())


def aliases(site: str) -> tuple[str, ...]:
    """File name beginnings of a site; an explicit list replaces the derived forms."""
    explicit = rule_for(site).aliases
    return explicit or tuple(dict.fromkeys((site, site.replace(" ", "_"), site.replace(" ", ""))))
