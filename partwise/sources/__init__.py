"""Reading objects and upload state, writing parts, files and progress."""
