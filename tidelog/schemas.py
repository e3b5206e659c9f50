"""Column names and types of the inputs and outputs.

The names below are fixed values: files written by other systems carry them.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# The six tab-separated fields of a machine log line, in file order.
# Left: name used inside this package; right: name at the sinks.
LOG_FIELDS = {
    "stamp": "DataHora",
    "level": "LogLevel",
    "machine": "CodigoUrna",
    "action": "Acao",
    "message": "Mensagem",
    "check_code": "Código Verificação",
}

LOG_SCHEMA = StructType([StructField(name, StringType()) for name in LOG_FIELDS])

# Log vocabulary and formats.
STAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"
DAY_FORMAT = "dd/MM/yyyy"
VOTE_ACTION = "VOTA"
VOTE_LEVEL = "INFO"
VOTE_START = "Eleitor foi habilitado"
VOTE_END = "O voto do eleitor foi computado"
FIRST_DAY = "2024-10-06"

# Header facts of a machine log. Output name -> (text to look for, separator before the value).
HEADER_FACTS = {
    "Turno da UE": ("Turno da UE", ":"),
    "Modelo de Urna": ("Modelo de Urna", ":"),
    "Fase da UE": ("Fase da UE", ":"),
    "Modo de Carga da UE": ("Modo de carga da UE", "-"),
    "Município": ("Município", ":"),
    "Zona Eleitoral": ("Zona Eleitoral", ":"),
    "Seção Eleitoral": ("Seção Eleitoral", ":"),
}

# Columns kept of the machine/precinct table.
CORRESPONDENCE_COLUMNS = [
    "AA_ELEICAO",
    "CD_PLEITO",
    "SG_UF",
    "CD_MUNICIPIO",
    "NM_MUNICIPIO",
    "NR_ZONA",
    "NR_URNA_ESPERADA",
]
