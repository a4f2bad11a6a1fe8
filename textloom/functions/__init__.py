"""Column functions: text cleaning, text quality, audits, hashing and vectors."""
