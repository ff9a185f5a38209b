"""Explicit schemas of the stored tables."""

RAW_TEXT = "text string"
VOCABULARY = "label bigint, intent string"
SFT = (
    "text string, label bigint, intent string, "
    "instruction string, input string, output string"
)
SFT_COLUMNS = ["text", "label", "intent", "instruction", "input", "output"]
REPORT = (
    "section_no int, section string, label string, "
    "precision double, recall double, f1 double, support bigint"
)
MANIFEST = (
    "run_name string, created_at_utc string, "
    "source_paths struct<outputs:string,sample_data:string,configs:string>, "
    "test_accuracy_percent string"
)
