"""The two jobs, composed of operators, and the reports over the audit result."""
