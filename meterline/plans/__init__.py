"""Multi-step runs: ledger, work detection, versioned storage, publication."""
