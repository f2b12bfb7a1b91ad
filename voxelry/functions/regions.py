"""Anatomical label tables.

The numbers and names below are fixed values of the anatomical schemes (FreeSurfer codes, derived codes, region names).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: cortical parcels of each lobe, left hemisphere; right = left + 1000 -------------------------------
LOBE_PARCELS = {
    "Frontal": [1002, 1003, 1012, 1014, 1017, 1018, 1019, 1020, 1024, 1026, 1027, 1028, 1032],
    "Parietal": [1008, 1010, 1022, 1023, 1025, 1029, 1031],
    "Temporal": [1001, 1006, 1007, 1009, 1015, 1016, 1030, 1033, 1034],
    "Occipital": [1005, 1011, 1013, 1021],
}
RIGHT_PARCEL = 1000
#: Parcels left out of the lobe seeds; they are filled like white matter.
FILLED_PARCELS = [1002, 1010, 1017, 1023, 1026]
CINGULATE_PARCELS = [1002, 1010, 1023, 1026]
CORPUS_CALLOSUM = [251, 252, 253, 254, 255]

# --- fixed values: other structures, FreeSurfer codes (left, right) ---------------------------------------------------
STRUCTURES = {
    "Insula": ([1035], [2035]),
    "Basal ganglia": ([11, 12, 13, 26], [50, 51, 52, 58]),
    "Thalamus": ([10], [49]),
    "Ventral DC": ([28], [60]),
    "Hippocampus": ([17, 18], [53, 54]),
    "Cerebellum": ([7, 8], [46, 47]),
}
WHITE_MATTER = {"L": 2, "R": 41}
HYPERINTENSITY = 77
BRAINSTEM = 16
THIRD_VENTRICLE = 14
PUTAMEN = {"L": 12, "R": 51}
INSULA = {"L": 1035, "R": 2035}
VENTRICLES = {"L": [4, 5, 31], "R": [43, 44, 63]}
LATERAL_VENTRICLES = [4, 5, 43, 44]
CAPSULE_NUCLEI = {"L": [10, 11, 12, 13], "R": [49, 50, 51, 52]}
HIPPOCAMPUS_VENTRAL_DC = [17, 28, 53, 60]
BASAL_GANGLIA_BOX = [10, 11, 12, 13, 26, 49, 50, 51, 52, 58]

# --- fixed values: derived codes, left hemisphere ---------------------------------------------------------------------
LOBE_CODES = {"Frontal": 1, "Parietal": 5, "Temporal": 9, "Occipital": 13}
JUXTACORTICAL, DEEP, PERIVENTRICULAR = 1, 2, 3
STRUCTURE_CODES = {
    "Insula": 17,
    "Basal ganglia": 40,
    "Thalamus": 41,
    "Ventral DC": 42,
    "Hippocampus": 43,
    "Internal capsule": 44,
    "External capsule": 45,
    "Corpus callosum": 46,
    "Cerebellum": 47,
    "Basal ganglia periventricular": 78,
    "Thalamus periventricular": 79,
    "Internal capsule periventricular": 80,
}
RIGHT_LOBE, RIGHT_STRUCTURE, RIGHT_INSULA = 20, 10, 20
BRAINSTEM_CODE = 60


def code(name: str, side: str) -> int:
    """Derived code of a lobe or structure in one hemisphere (``L`` or ``R``)."""
    if name in LOBE_CODES:
        return LOBE_CODES[name] + (RIGHT_LOBE if side == "R" else 0)
    shift = RIGHT_INSULA if name == "Insula" else RIGHT_STRUCTURE
    return STRUCTURE_CODES[name] + (shift if side == "R" else 0)


# --- fixed values: regions of each scheme as (region code, name, derived codes) ---------------------------------------
SCHEMES = {
    "pvs": [
        (1, "Left Deep WM", [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 46]),
        (2, "Left Basal Gang.", [17, 40, 41, 44, 45, 78, 79, 80]),
        (3, "Left Hippoc.", [43]),
        (4, "Left Cerebellar", [47]),
        (5, "Left Ventral DC", [42]),
        (6, "Right Deep WM", [21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 32, 33, 34, 35, 36, 56]),
        (7, "Right Basal Gang.", [37, 50, 51, 54, 55, 88, 89, 90]),
        (8, "Right Hippoc.", [53]),
        (9, "Right Cerebellar", [57]),
        (10, "Right Ventral DC", [52]),
        (11, "Brainstem", [60]),
    ],
    "wmh": [
        (1, "Left Shallow WM", [1, 2, 5, 6, 9, 10, 13, 14, 17, 45]),
        (2, "Left Deep WM", [3, 7, 11, 15, 40, 41, 44, 46]),
        (3, "Left PV WM", [4, 8, 12, 16, 78, 79, 80]),
        (4, "Left Cerebellar", [47]),
        (5, "Right Shallow WM", [21, 22, 25, 26, 29, 30, 33, 34, 37, 55]),
        (6, "Right Deep WM", [23, 27, 31, 35, 50, 51, 54, 56]),
        (7, "Right PV WM", [24, 28, 32, 36, 88, 89, 90]),
        (8, "Right Cerebellar", [57]),
        (9, "Brainstem", [60]),
    ],
    "mars": [
        (1, "Left Frontal", [1, 2]),
        (2, "Left Parietal", [5, 6]),
        (3, "Left Temporal", [9, 10]),
        (4, "Left Occipital", [13, 14]),
        (5, "Left Insula", [17, 80]),
        (6, "Left Basal Gang.", [40, 78]),
        (7, "Left Thalamus", [41, 79]),
        (8, "Left Ventral DC", [42]),
        (9, "Left Hippoc.", [43]),
        (10, "Left Int. Caps.", [44]),
        (11, "Left Ext. Caps.", [45]),
        (12, "Left Corp. Call.", [46]),
        (13, "Left D&PV WM", [3, 4, 7, 8, 11, 12, 15, 16]),
        (14, "Left Cerebellum", [47]),
        (15, "Right Frontal", [21, 22]),
        (16, "Right Parietal", [25, 26]),
        (17, "Right Temporal", [29, 30]),
        (18, "Right Occipital", [33, 34]),
        (19, "Right Insula", [37, 90]),
        (20, "Right Basal Gang.", [50, 88]),
        (21, "Right Thalamus", [51, 89]),
        (22, "Right Ventral DC", [52]),
        (23, "Right Hippoc.", [53]),
        (24, "Right Int. Caps.", [54]),
        (25, "Right Ext. Caps.", [55]),
        (26, "Right Corp. Call.", [56]),
        (27, "Right D&PV WM", [23, 24, 27, 28, 31, 32, 35, 36]),
        (28, "Right Cerebellum", [57]),
        (29, "Brainstem", [60]),
    ],
}
BIOMARKER_SCHEME = {"pvs": "pvs", "wmh": "wmh", "cmb": "mars", "lac": "mars"}
PRIORITY_REGIONS = {"wmh": ["Left PV WM", "Right PV WM"]}
WHOLE_BRAIN = "Whole brain"
WHOLE_BRAIN_CODE = -1

# --- fixed values: named FreeSurfer regions ---------------------------------------------------------------------------
FS_REGIONS = {
    "Left cerebral WM": 2,
    "Left cerebral ctx": 3,
    "Left cerebellum WM": 7,
    "Left cerebellum ctx": 8,
    "Left thalamus": 10,
    "Left caudate": 11,
    "Left putamen": 12,
    "Left pallidum": 13,
    "Brain stem": 16,
    "Left hippocampus": 17,
    "Left amygdala": 18,
    "Left accumbens area": 26,
    "Left ventral DC": 28,
    "Right cerebral WM": 41,
    "Right cerebral ctx": 42,
    "Right cerebellum WM": 46,
    "Right cerebellum ctx": 47,
    "Right thalamus": 49,
    "Right caudate": 50,
    "Right putamen": 51,
    "Right pallidum": 52,
    "Right hippocampus": 53,
    "Right amygdala": 54,
    "Right accumbens area": 58,
    "Right ventral DC": 60,
}
FS_CSF = 24
FS_CORTEX = {"L": (1000, 1035, 3), "R": (2000, 2035, 42)}


def scheme_rows(scheme: str) -> list[tuple[int, int, str]]:
    """(derived code, region code, region name) of a scheme."""
    return [(src, label, name) for label, name, members in SCHEMES[scheme] for src in members]


def scheme_lut(spark: SparkSession, scheme: str) -> DataFrame:
    return spark.createDataFrame(scheme_rows(scheme), "src_label int, region_label int, region string")


def region_dictionary(spark: SparkSession, scheme: str) -> DataFrame:
    """Region codes and names in report order, without the whole brain."""
    rows = [(label, name, n) for n, (label, name, _) in enumerate(SCHEMES[scheme], start=1)]
    return spark.createDataFrame(rows, "region_label int, region string, ord int")
