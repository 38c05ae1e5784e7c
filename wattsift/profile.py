"""Column roles of the tables the operators work on.

Operators never name a column themselves: they take a ``Profile``.  ``ENERGY`` is the
building-energy table; another table with the same roles needs only another profile.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    row_id: str
    year: str
    pooled_years: str
    occupation: str
    mono_code: str
    mono_flag: str
    context: tuple[str, ...]
    ratios: tuple[str, str]
    splits: tuple[str, ...]
    shares: tuple[str, ...]
    counts: tuple[str, ...]
    categoricals: tuple[str, ...]
    features: tuple[str, ...]
    delta: str
    shares_sum: str
    shares_valid: str
    splits_sum: str
    splits_valid: str

    @property
    def numeric(self) -> tuple[str, ...]:
        return self.ratios + self.splits + self.shares + self.counts

    @property
    def encoded(self) -> tuple[str, ...]:
        """Order of the model matrix: categoricals, then numbers."""
        return self.categoricals + self.numeric

    @property
    def derived(self) -> tuple[str, ...]:
        return (self.shares_sum, self.shares_valid, self.splits_sum, self.splits_valid, self.delta)


# ---- fixed values: the column names and codes of the public energy table ----

_SHARES = (
    "electricite_pct",
    "gaz_naturel_reseau_pct",
    "gaz_naturel_liquefie_pct",
    "gaz_propane_pct",
    "gaz_butane_pct",
    "fioul_domestique_pct",
    "charbon_pct",
    "houille_pct",
    "bois_pct",
    "reseau_de_chaleur_pct",
    "reseau_de_froid_pct",
    "gazole_non_routier_pct",
)
_SPLITS = (
    "consommation_individuelle_pct",
    "consommation_espaces_communs_pct",
    "consommation_repartie_pct",
)
_RATIOS = (
    "ratio_de_consommation_ajustee_du_climat_kwh_par_m2",
    "ratio_de_consommation_brut_kwh_par_m2",
)
_COUNTS = (
    "nombre_de_categories_activite_distinctes",
    "nombre_de_sous_categories_activite_distinctes",
)
_YEAR = "annee_de_consommation"
_OCCUPATION = "cas_assujettissement_efa"
_ACTIVITY = "categorie_activite_majoritaire_efa"
_SUB_ACTIVITY = "sous_categorie_activite_majoritaire_efa"
_MONO = "is_mono_occupation"

ENERGY = Profile(
    row_id="source_row_id",
    year=_YEAR,
    pooled_years="2010-2019",
    occupation=_OCCUPATION,
    mono_code="1A",
    mono_flag=_MONO,
    context=(_ACTIVITY, _SUB_ACTIVITY, _OCCUPATION),
    ratios=_RATIOS,
    splits=_SPLITS,
    shares=_SHARES,
    counts=_COUNTS,
    categoricals=(_YEAR, _OCCUPATION, _ACTIVITY, _SUB_ACTIVITY, _MONO),
    features=(_YEAR, _OCCUPATION, _ACTIVITY, _SUB_ACTIVITY, *_COUNTS, *_RATIOS, *_SPLITS, *_SHARES, _MONO),
    delta="delta_climat_kwh_m2",
    shares_sum="sum_energy_mix_percent",
    shares_valid="is_valid_energy_mix",
    splits_sum="sum_building_split_percent",
    splits_valid="is_valid_building_split",
)

ANOMALY_TYPES = ("contextual", "correlational", "structural", "energy_mix", "combination")

DEFAULT_WEIGHTS = {
    "contextual": 0.20,
    "correlational": 0.25,
    "structural": 0.20,
    "energy_mix": 0.25,
    "combination": 0.10,
}

SEVERITY = {
    "contextual": "high",
    "correlational": "medium",
    "structural": "medium",
    "energy_mix": "high",
    "combination": "high",
}

LABEL_COLUMNS = ("is_anomaly", "anomaly_type", "anomaly_severity")
