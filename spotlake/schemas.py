"""Column specifications: the single source for reading, cleaning and projecting.

Each medium is a list of ``name kind`` pairs in table order. The kind decides the target
type, the cleaning rule and the value that stands for "missing".
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---- Fixed values: table layouts -----------------------------------------------------
# date = day key, int / long / double = number, label = folded text of bounded width,
# text = long text, raw = text kept as it arrives, time = clock text

SPOT_LAYOUT = """
Fecha date
IdPlaza int
Plaza label
IdLocalidad int
Localidad label
IdMedio int
Medio label
IdTipoMedio int
TipoMedio label
IdCanal int
Canal label
HInicio time
HFinal time
IdMarca int
Marca label
IdSubmarca int
Submarca label
IdProducto int
Producto label
IdVersion long
Version raw
DReal int
DTeorica int
IdTipoSpot int
TipoSpot label
IdSubTipoSpot int
SubTipoSpot label
IdTipoCorte int
TipoCorte label
NoCorte int
PEnCorte time
IdCampania int
Campania label
IdCorporativo int
Corporativo label
IdAnunciante int
Anunciante label
IdAgenciaP int
AgenciaP label
IdCentralMedios int
CentralMedios label
IdIndustria int
Industria label
IdMercado int
Mercado label
IdSegmento int
Segmento label
IdDeteccion long
Tarifa double
Testigo raw
IdPrograma int
Programa label
Subtitulo text
IdGenero int
Genero label
FHoraria label
GComercial label
GEstacion label
Origen label
VerCodigo label
"""

PRINT_LAYOUT = """
Fecha date
IdMedio int
Medio label
IdFuente int
Fuente label
Autor label
Seccion label
Pagina label
Anunciante label
Marca label
Submarca label
Producto label
Sector label
Subsector label
Categoria label
Tiraje long
Costo double
Dimension double
Testigo label
TextoNota label
"""

LIBRARY_LAYOUT = """
IdMaster long
TipoMaster label
Version text
Anunciante label
Marca label
Submarca label
Producto label
Segmento label
Industria label
Mercado label
DTeorica int
Testigo text
"""

TOTALS_LAYOUT = """
FechaInicio date
FechaFin date
Periodo text
Medio label
Canal label
GEstacion label
FHoraria label
NoCorte int
TipoSpot label
Genero label
TipoMaster label
IdMaster long
Version text
Anunciante label
Marca label
Submarca label
Producto label
Segmento label
Industria label
Mercado label
DTeorica int
TotalHit int
TotalInversion double
Testigo text
"""

MEDIA = ("tv", "radio", "impresos")
MISSING = "N.A."
LABEL_WIDTH = {"tv": 255, "radio": 255, "impresos": 128, "library": 255, "totals": 255}
TIME_WIDTH = 50
# ---- end of fixed values -------------------------------------------------------------

_TYPES = {
    "date": T.DateType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
}


@dataclass(frozen=True)
class Column:
    name: str
    kind: str

    @property
    def type(self) -> T.DataType:
        return _TYPES.get(self.kind, T.StringType())

    @property
    def is_text(self) -> bool:
        return self.kind in ("label", "text", "raw", "time")


def _layout(text: str) -> tuple[Column, ...]:
    return tuple(Column(*line.split()) for line in text.split("\n") if line)


SPOTS = _layout(SPOT_LAYOUT)
PRINT_ADS = _layout(PRINT_LAYOUT)
LIBRARY = _layout(LIBRARY_LAYOUT)
TOTALS = _layout(TOTALS_LAYOUT)

SPECS: dict[str, tuple[Column, ...]] = {
    "tv": SPOTS,
    "radio": SPOTS,
    "impresos": PRINT_ADS,
    "library": LIBRARY,
    "totals": TOTALS,
}

# the column that identifies a row of each feed; a row without it is rejected
KEY_COLUMN = {
    "tv": "IdDeteccion",
    "radio": "IdDeteccion",
    "impresos": "IdMedio",
    "library": "IdMaster",
    "totals": "IdMaster",
}

SPEND_COLUMN = {"tv": "Tarifa", "radio": "Tarifa", "impresos": "Costo", "totals": "TotalInversion"}
SECTOR_COLUMN = {"tv": "Industria", "radio": "Industria", "impresos": "Sector"}


def raw_schema(*feeds: str) -> T.StructType:
    """All-text read schema covering the given feeds, plus the corrupt-record column."""
    names = dict.fromkeys(c.name for feed in feeds for c in SPECS[feed])
    fields = [T.StructField(n, T.StringType()) for n in names]
    return T.StructType([*fields, T.StructField("_corrupt_record", T.StringType())])


def table_schema(feed: str) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.type) for c in SPECS[feed]])


def display_columns(names: list[str]) -> list[str]:
    """Columns shown to a reader: everything but the surrogate id and the Id* keys."""
    return [n for n in names if n != "id" and not n.startswith("Id")]
