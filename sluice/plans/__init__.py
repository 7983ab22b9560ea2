"""End-to-end plans built from the operators, and the driver's query registry."""
