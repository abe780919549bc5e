"""Constants that must equal the scored system's values for identical results."""

from __future__ import annotations

# ---- fixed values (must match the scored system exactly) -------------------
KMH_TO_MPH = 0.6213711922
OVERSPEED_EVENT_ID = -1879048190
DA_EVENT_ID = 1048576
ECS_EVENT_ID = 1
CMB_EVENT_IDS = (32, 4096, 1024)
ESPRSP_EVENT_IDS = (131072, 32768)
BATCH_MINUTES = 30
DEDUP_GAP_SECONDS = 60
LABEL_LOW = "Pre-Grouped (Low)"
LABEL_MID = "Pre-Grouped (Mid)"
LABEL_HIGH = "Pre-Grouped (High)"
# inclusive score bands -> label; anything outside gets no label
LABEL_BANDS = ((1, 39, LABEL_LOW), (40, 69, LABEL_MID), (70, 100, LABEL_HIGH))
CLASSIFIED_BY = "AER Classification"
ROSTER_SETTING = "AutoEventClassification"
# ---------------------------------------------------------------------------
