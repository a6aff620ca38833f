"""Default parameters. Operators take all of them as keyword arguments."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# Month spellings, era labels, date ranges and word lists that results depend on.
MONTHS_ES = {
    "Enero": 1, "Febrero": 2, "Marzo": 3, "Abril": 4, "Mayo": 5, "Junio": 6,
    "Julio": 7, "Agosto": 8, "Septiembre": 9, "Octubre": 10, "Noviembre": 11, "Diciembre": 12,
}
ERA_BEFORE = "Peña Nieto"
ERA_AFTER = "AMLO"
FIRST_YEAR_RANGES = (
    ("Peña Nieto (Dic2012-Nov2013)", date(2012, 12, 1), date(2013, 11, 30)),
    ("AMLO (Dic2018-Nov2019)", date(2018, 12, 1), date(2019, 11, 30)),
)
TEXT_COLUMNS = ("nombre", "subtema", "sector", "tema", "clave_de_concepto")
STOPWORDS_ES = frozenset("""
    de la que el en y a los del se las por un para con no una su al lo como
    mas pero sus le ya o este si porque esta entre cuando muy sin sobre tambien me
    hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese eso
    ante ellos e esto antes algunos unos yo otro otras otra tanto esa estos
    mucho quienes nada muchos cual poco ella estar estas algunas algo nosotros mi mis tu
    te ti tus ellas nosotras vosotros vosotras os mio mia mios mias tuyo tuya tuyos
    tuyas suyo suya suyos suyas nuestro nuestra nuestros nuestras vuestro vuestra vuestros
    vuestras esos esas estoy estas esta estamos estan ser es son fue era han
    he has ha haya haber va van ir
    enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre
""".split())
STOPWORDS_FISCAL = frozenset("""
    estadisticas finanzas publicas publica miles pesos mensual pagado devengado flujo
    ingreso ingresos gasto gastos financiamiento resultado operacion variacion disponibilidades
    sector ambito federal gobierno nacional servicio servicios instituto comision empresa
    otros otras concepto nombre tema subtema periodo frecuencia difusion base registro
    unidad unidades medida mexico mexicana mexicanas
""".split())
# End of fixed values.


@dataclass(frozen=True)
class Defaults:
    era_cutoff: date = date(2018, 12, 1)
    era_before: str = ERA_BEFORE
    era_after: str = ERA_AFTER
    holdout_start: date = date(2022, 1, 1)
    clean_from: date = date(2012, 12, 1)
    clean_to: date = date(2024, 9, 30)
    first_year_ranges: tuple = FIRST_YEAR_RANGES
    seed: int = 42
    scatter_cap: int = 1_200
    sample_rows: int = 20_000
    top_values: int = 10
    top_sectors: int = 5
    fdr_alpha: float = 0.05
    interval_factor: float = 1.96
    fallback_share: float = 0.8
    rolling_window: int = 3
    knn_k: tuple = (3, 5, 7, 9, 11, 15, 21, 31, 41)
    knn_weights: tuple = ("uniform", "distance")
    knn_p: tuple = (1, 2)
    folds: int = 5
    cluster_k: tuple = tuple(range(2, 11))
    horizon: int = 12
    top_terms: int = 100
    top_terms_category: int = 50
    min_df: int = 5
    max_features: int = 5_000
    cloud_words: int = 300
    text_columns: tuple = TEXT_COLUMNS
    stopwords: frozenset = field(default=STOPWORDS_ES | STOPWORDS_FISCAL)

    @property
    def slice_min_df(self) -> int:
        return max(3, self.min_df // 2)


DEFAULTS = Defaults()
