"""DataFrame steps: document jobs, rejection of repeats, change detection, accounting, audits."""
