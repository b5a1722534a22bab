"""DataFrame operators: data-quality audits/cleaners and ranking (top-1,
keep-one dedupe, exact distributed NTILE)."""
