"""The five jobs, composed from the operators. Building one runs no job but writes of shared tables."""
