"""Limits of the multipart store and sizes the library works with."""

# They must equal the store's published limits.
MIN_PART_SIZE = 5 * 1024**2
MAX_PART_SIZE = 5 * 1024**3
MAX_PARTS_PER_UPLOAD = 10_000

# Bytes handed to a digest at a time.
READ_BUFFER = 1024**2

# Parts of one object that may meet in one group. A group keyed by object and block of parts
# stays this small however large the object is. A power of two: the block is a shift away.
BLOCK_BITS = 12
BLOCK_PARTS = 1 << BLOCK_BITS

# Most bytes one cell may hold: far below the 2 GiB limit of a Java array.
MAX_CELL_BYTES = 256 * 1024**2

# Bytes of a row of an assembled object.
CHUNK_BYTES = 64 * 1024**2

# Bytes of file content gathered before an Arrow batch leaves a Python worker.
BATCH_BYTES = 32 * 1024**2
