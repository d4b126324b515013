"""Column lists of the tables, as name to Spark type."""

from __future__ import annotations

# Table layouts shared with the crop models.
CLIMATE = {
    "idPoint": "string",
    "w_date": "string",
    "year": "int",
    "DOY": "int",
    "Nmonth": "int",
    "NdayM": "int",
    "srad": "double",
    "tmax": "double",
    "tmin": "double",
    "tmoy": "double",
    "rain": "double",
    "wind": "double",
    "rhum": "double",
    "Etppm": "double",
    "Tdewmin": "double",
    "Tdewmax": "double",
    "Surfpress": "double",
}

CLIMATE_VALUES = [name for name, kind in CLIMATE.items() if kind == "double"]

SOIL_VALUES = [
    "SoilTotalDepth",
    "SoilRDepth",
    "Wwp",
    "Wfc",
    "bd",
    "OrganicNStock",
    "pH",
    "OrganicC",
    "cf",
    "extp",
    "totp",
    "sand",
    "clay",
    "silt",
]

SOIL = {
    "IdSoil": "string",
    **dict.fromkeys(SOIL_VALUES, "double"),
    "SoilTextureType": "string",
    "SoilOption": "string",
    "Slope": "string",
    "RunoffType": "int",
    "albedo": "double",
}

COORDINATES = {
    "altitude": "int",
    "latitudeDD": "double",
    "longitudeDD": "double",
    "codeSWstation": "string",
    "idPoint": "string",
    "startRain": "string",
    "EndRain": "string",
}

COORDINATES_LEGACY = {**COORDINATES, "SourceW": "string", "SourceRain": "string", "Comment": "string", "ev": "string"}

SIM_UNITS = {
    "idOption": "int",
    "idPoint": "string",
    "idMangt": "string",
    "IdSoil": "string",
    "StartYear": "int",
    "StartDay": "int",
    "EndYear": "int",
    "EndDay": "int",
    "idIni": "int",
    "idsim": "string",
}

MODEL_DATES = ["Planting", "Emergence", "Ant", "Mat"]

OUTPUT_VALUES = [
    *MODEL_DATES,
    "Biom_ma",
    "Yield",
    "GNumber",
    "MaxLai",
    "Nleac",
    "SoilN",
    "CroN_ma",
    "CumE",
    "Transp",
]

RAW_OUTPUT = {
    "Model": "string",
    "Idsim": "string",
    "Texte": "string",
    **dict.fromkeys(OUTPUT_VALUES, "double"),
    "time": "int",
    "lat": "double",
    "lon": "double",
}

SUMMARY_OUTPUT = {
    "Model": "string",
    "Idsim": "string",
    "Texte": "string",
    **dict.fromkeys(OUTPUT_VALUES, "double"),
}

MODEL_WEATHER = {
    "IdDClim": "string",
    "idjourclim": "string",
    "annee": "int",
    "jda": "int",
    "mois": "int",
    "jour": "int",
    "tmax": "double",
    "tmin": "double",
    "tmoy": "double",
    "rg": "double",
    "plu": "double",
    "Etp": "double",
}

POINTS = {"lon": "double", "lat": "double"}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
