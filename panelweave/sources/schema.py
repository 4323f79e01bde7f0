"""Schema of the hourly entity files."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the public hourly intensive-care data, in file order.
VITALS_AND_LABS = (
    "HR", "O2Sat", "Temp", "SBP", "MAP", "DBP", "Resp", "EtCO2", "BaseExcess", "HCO3", "FiO2", "pH",
    "PaCO2", "SaO2", "AST", "BUN", "Alkalinephos", "Calcium", "Chloride", "Creatinine",
    "Bilirubin_direct", "Glucose", "Lactate", "Magnesium", "Phosphate", "Potassium", "Bilirubin_total",
    "TroponinI", "Hct", "Hgb", "PTT", "WBC", "Fibrinogen", "Platelets",
)
STATICS = ("Age", "Gender", "Unit1", "Unit2", "HospAdmTime")
HOUR = "ICULOS"
LABEL = "SepsisLabel"
UNUSED = ("Unit1", "Unit2")

HOURLY_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in VITALS_AND_LABS]
    + [T.StructField(c, T.IntegerType() if c == "Gender" else T.DoubleType()) for c in STATICS]
    + [T.StructField(HOUR, T.IntegerType()), T.StructField(LABEL, T.IntegerType())]
)
