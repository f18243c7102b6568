"""Typed run parameters.

The jobs take a date range, a hero id, a rating floor, a list of game modes,
an sdk version (used only as a path part) and a score floor.  Dates are accepted
as ``YYYY-MM-DD`` or ``YYYYMMDD`` and normalised once, so that every string
comparison in the plans is between ISO dates.
"""

from __future__ import annotations

import datetime as _dt
import math
import re
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values of the production jobs (must equal the original job settings).
# Version-era rule: before the cutoff date only these client versions are
# usable; from the cutoff on every version is kept.
# ---------------------------------------------------------------------------
DEFAULT_VERSION_CUTOFF = "2021-02-01"
DEFAULT_VERSION_ALLOW_LIST = (
    "7e2f822dbce0a467fa2ff4d73d15ba79",
    "fd60727790f071afcdbef957398facfb",
    "5e19e13dfc75f4c189af19824ef19f60",
    "3a3c6195b5b2f83a725e8643d89dd8cd",
    "93bc2e52028862e4c52a769890789897",
    "0a37bdd2907051b125fea063070ccf32",
    "2fe302084292bac40498494db90d1b5a",
    "403ce5730541409eaf94629b0f5e2392",
    "9e1e37d233343d3605c7e8ecbb43c337",
    "0abddf9ca85150b48f4d47ca1e4babb2",
    "1ccc50f7d9c2ee0f25484a39480c3a22",
    "f094aca2ce15aa18bf4d4445167a1e05",
    "9f361b1072313ee5703a94f0e17c9f59",
    "7f510e9f9a64d00c3bdbe16f7935d950",
    "e2535a5f10f391a2d80edf6f1f79209c",
    "a2a1be1a319237a3b49bc35425060d47",
    "9bd9f3ff714ff988a216cc2866ac51bf",
    "d7e8dbbf1b999c1aeec23064222ac492",
    "e2a76a934e6899542942d3f2528d9084",
    "84d2e38efdeaed20aab8d614d1ec83ff",
    "5e746f1129aea092de5f7a1d6984c434",
    "85011653d817dc4f549d2c32762ab4b6",
    "ca5ad93519bec1a9b213773826716620",
    "41219986359fdf9b4c5f904041d88d65",
    "2bbc312aaceb5ca64c7b7ef5a0db0333",
    "42c79a0b758715bc66147e3083d4815b",
    "375fabc77a4c2c206005b22815416786",
    "28dabaf4731ea0a5c7b024d6ce71dcfa",
    "a5767d7203ae99717acc705ab0293954",
    "409326c188b8d8e760495d381697e1bd",
    "0e85bee7b54622d0bfc9898d55a62949",
    "e6845e4a2bdc64a4cc6c61681dd65166",
    "e103bac6acdc0059fa780613c3de4262",
    "da1859457d5b76cb3f9a269f2f8aeb6d",
    "bdd04d59f24f71621c19f1625a30fe2a",
    "dfdaf605cfe13e50cae1d1b41a48f771",
    "2152b6b44c2eaab4f60d9cad3c56ed5d",
    "5d4157de0ed41161385c38d18443d5a3",
    "dc0ac9a1390d4dd66925d3bf474521a0",
    "20162a1aaa33a9ee581ce9f317d65087",
    "7c98a5c9f90adad30ab21f2b1e667f65",
    "d353ce2f89a84766c6225cb687c48167",
    "1b2c402dac38001174f05d25a9dc3d4a",
    "9c32be41a504980a0e27428944c7d371",
    "d9931a841d25f89b5ccf04ca0225f7de",
    "3ec352627bcad30a46e75ea6a8c36a83",
    "3801b5326fbcbb4cdeeb409b4b95f160",
    "97426cd502521b192843d32bc186eaf3",
    "a47804534a4ab6345218232b21c269fa",
    "15c13005aace489d540eec3c0078d419",
    "b8e95d078a4c9b290ef5603e276c333f",
    "aca63a6b28e99dd99f58adcf8b0fd727",
    "53ec1201c485f9f5b902ea9ca60d6e26",
    "188a3d88f06b778e276e52455719a2cd",
    "b272bacc55813a44f35d95b87ae04b0d",
    "8c87800eb9b0e96c31e368e6b0665bbe",
    "a14c0db1a1c9c14250d8955b64c50bd8",
    "ce9914d779bb76515f3e5c53c1b65d78",
    "f5ffa2073fd97ccd7148a61e35502a3f",
    "a044723084a4041aee1e77fff8b70c23",
    "7db6a2c60b8f3b2cb436efe64056a132",
    "4ffc29e19b6699dfc2d7e06029164e14",
    "89932334c7131bf2437d49b6d6cc9e8f",
    "2dc9d1b9f24c60b77eac1c2a605530c3",
    "b5e0a23bae331bf2c35877f61d9a1c53",
    "4f7981ae15f7cf18b332593a0be0ef67",
    "62ce46d2b3909162190f127d7da7fd9d",
    "3c85d48078eae722f0936fb1099061b2",
    "5e3c73d1c3d2fd1dd7308b84ce877f97",
    "baf4ad3d518b8fee6515573b56104823",
    "c578a4e8cb33a761be4bf0c3f66fb05f",
    "645b0be4913dab734b94830038e10f07",
    "bc80257e2e51b4712771b3175ad369cf",
    "e3d5a94a0e769cd98c13fca72e812388",
    "8d31d433401ceead9b2efec608520f67",
    "6c9de2090002b84b1af65e528eed6819",
    "e8b4776f68403a70141f80571e1c8224",
    "8c9945acabcc9416b9ab523cdb6d2523",
    "b335f93828c3260886266237397b3c85",
    "4274deafa9c73eda59d89d68fc038216",
)
# Participants per match required by the qualifying filter.
EXPECTED_USERNUM = 10
# ---------------------------------------------------------------------------

_ISO = re.compile(r"^\d{4}-\d{2}-\d{2}$")
_COMPACT = re.compile(r"^\d{8}$")


def normalise_date(value: str) -> str:
    """Return ``value`` as ``YYYY-MM-DD``; accepts ISO or compact ``YYYYMMDD``.

    Anything else (or an impossible calendar date) raises ``ValueError``.
    """
    text = str(value).strip()
    if _COMPACT.match(text):
        text = f"{text[0:4]}-{text[4:6]}-{text[6:8]}"
    if not _ISO.match(text):
        raise ValueError(f"not a date in YYYY-MM-DD or YYYYMMDD form: {value!r}")
    _dt.date.fromisoformat(text)  # validates month/day
    return text


def compact_date(value: str) -> str:
    """ISO date to the compact form used in export paths (dashes removed)."""
    return normalise_date(value).replace("-", "")


def _threshold(value) -> int | float:
    """A whole number as ``int``, any other as ``float``."""
    number = float(value)
    if not math.isfinite(number):
        raise ValueError(f"not a number: {value!r}")
    return int(number) if number.is_integer() else number


def _int_list(value) -> tuple[int, ...]:
    if isinstance(value, str):
        parts = [p for p in (s.strip() for s in value.split(",")) if p]
    else:
        parts = list(value)
    if not parts:
        raise ValueError("mode list must not be empty")
    return tuple(int(p) for p in parts)


@dataclass(frozen=True)
class RunParams:
    """Parameters of one extraction run.

    ``sdk_version`` never filters rows; it is only a part of the export path.
    """

    start_date: str
    end_date: str
    hero_id: int
    team_elo: int | float
    modetids: tuple[int, ...]
    sdk_version: str
    score: int | float
    version_cutoff: str = DEFAULT_VERSION_CUTOFF
    version_allow_list: tuple[str, ...] = field(default=DEFAULT_VERSION_ALLOW_LIST)
    usernum: int = EXPECTED_USERNUM

    def __post_init__(self):
        object.__setattr__(self, "start_date", normalise_date(self.start_date))
        object.__setattr__(self, "end_date", normalise_date(self.end_date))
        object.__setattr__(self, "version_cutoff", normalise_date(self.version_cutoff))
        object.__setattr__(self, "hero_id", int(self.hero_id))
        object.__setattr__(self, "team_elo", _threshold(self.team_elo))
        object.__setattr__(self, "score", _threshold(self.score))
        object.__setattr__(self, "usernum", int(self.usernum))
        object.__setattr__(self, "modetids", _int_list(self.modetids))
        object.__setattr__(self, "version_allow_list", tuple(str(v) for v in self.version_allow_list))
        if self.start_date > self.end_date:
            raise ValueError(f"start_date {self.start_date} is after end_date {self.end_date}")

    @classmethod
    def from_argv(cls, argv: list[str], **overrides) -> "RunParams":
        """Positional form of the original jobs: start end hero elo modes sdk score."""
        if len(argv) < 7:
            raise ValueError("expected: start_date end_date hero_id team_elo modetids sdk_version score")
        start, end, hero, elo, modes, sdk, score = argv[:7]
        return cls(start, end, hero, elo, modes, sdk, score, **overrides)

    def export_path(self, root: str, export: str, compact: bool = True) -> str:
        """``<root>/<export>/<hero>/<sdk>/<start>-<end>/``.

        ``compact=True`` writes the dates without dashes (the match and
        player exports); ``compact=False`` keeps ISO dates (the participant
        export).
        """
        fmt = compact_date if compact else normalise_date
        rng = f"{fmt(self.start_date)}-{fmt(self.end_date)}"
        return f"{root.rstrip('/')}/{export}/{self.hero_id}/{self.sdk_version}/{rng}/"
