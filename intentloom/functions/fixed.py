"""Values that are part of the data format and must stay exactly as they are."""

# The prompt texts, the answer mark and the control words are what
# trained models and stored reports contain, so they cannot be reworded.
INSTRUCTION_TEMPLATE = (
    "You are a banking intent classifier. Given a customer's message, "
    "classify it into EXACTLY ONE of these intents: {label_list}. "
    "Only output the intent label, nothing else."
)
INSTRUCTION_WITHOUT_LABELS = (
    "You are a banking intent classifier. Given a customer's message, "
    "classify it into one of the banking intent categories. "
    "Only output the intent label, nothing else."
)
PROMPT_TEMPLATE = """\
Below is an instruction that describes a task, paired with an input that provides \
further context. Write a response that appropriately completes the request.

### Instruction:
{instruction}

### Input:
{input}

### Response:
{output}"""
ANSWER_MARK = "### Response:"
CONTROL_WORDS = ("quit", "exit", "q")
ACCURACY_HEADING = "Test Accuracy: "
REPORT_HEADING = "Classification Report:"
ACCURACY_PATTERN = r"Test Accuracy:\s*([0-9]+(?:\.[0-9]+)?)%"
VERSION_PATTERN = r"checkpoint-([0-9]+)"

# The parameters a run uses unless told otherwise.
SEED = 42
TRAIN_ROWS_PER_CLASS = 50
TEST_ROWS_PER_CLASS = 20
FUZZY_CUTOFF = 0.6
ACCURACY_EVERY = 200
PROMPT_LIMIT = 768
BATCH_ROWS = 8
ACCUMULATION = 4
EPOCHS = 3

# Every character Python's str.strip() removes: 29 of them, all below U+3001.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# Rounds of the keyed permutation of an epoch.
SWAP_ROUNDS = 24
