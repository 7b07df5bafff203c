"""Values that are part of the data contracts, not of the code."""

# Columns that identify a person directly.
DIRECT_IDENTIFIERS = [
    "patient_name",
    "mrn",
    "ssn",
    "phone",
    "email",
    "fax",
    "street_address",
    "device_id",
    "vehicle_id",
    "biometric_id",
    "photo_url",
    "url",
    "ip_address",
    "account_number",
    "certificate_number",
]

# Published 3-digit ZIP areas with too few residents to be kept.
RESTRICTED_ZIP3 = [
    "036", "059", "063", "102", "203", "556", "692", "790", "821",
    "823", "830", "831", "878", "879", "884", "890", "893",
]

# Overall tumour stages, least to most advanced; the rank is the position.
STAGE_ORDER = ["0", "I", "IA", "IB", "II", "IIA", "IIB", "III", "IIIA", "IIIB", "IIIC", "IV"]

# Pathway of each mapped gene, and the name for every other gene.
GENE_PATHWAYS = [
    ("TP53", "p53_signaling"),
    ("BRCA1", "dna_repair"),
    ("BRCA2", "dna_repair"),
    ("ATM", "dna_repair"),
    ("PIK3CA", "pi3k_akt"),
    ("PTEN", "pi3k_akt"),
    ("KRAS", "ras_mapk"),
    ("NRAS", "ras_mapk"),
    ("BRAF", "ras_mapk"),
    ("MYC", "cell_cycle"),
    ("CCND1", "cell_cycle"),
    ("RB1", "cell_cycle"),
]
UNMAPPED_PATHWAY = "unmapped"

# Registry extract layout as (name, first, last) position, both counted from 1.
REGISTRY_LAYOUT = [
    ("patient_id_number", 1, 8),
    ("sex", 24, 24),
    ("age_at_diagnosis", 25, 27),
    ("year_of_diagnosis", 28, 31),
    ("primary_site", 42, 45),
    ("county_of_residence", 46, 48),
    ("histology_icd_o3", 55, 58),
    ("stage_tnm_combined", 100, 103),
    ("survival_months", 200, 203),
    ("vital_status", 204, 204),
]

# Columns a model may use, when a table has them.
PATHWAY_FEATURES = ["p53_signaling", "dna_repair", "pi3k_akt", "ras_mapk", "cell_cycle", "unmapped"]
MAX_COMPONENTS = 50
MODEL_FEATURES = ["stage_rank", *[f"expression_pca_{i}" for i in range(MAX_COMPONENTS)], *PATHWAY_FEATURES]

# Operator and run parameters.
TOP_GENES = 2000
MIN_EXPRESSION_FILES = 5
LOOKBACK_DAYS = 30
MAX_SHIFT_DAYS = 365
MAD_SCALE = 1.4826
ROBUST_Z_THRESHOLD = 3.5
ZERO_MAD = 1e-9
