"""Reading and writing: raw CSV, landed archives, weather payloads, tables."""
