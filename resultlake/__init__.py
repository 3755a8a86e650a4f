"""resultlake: Spark jobs for competition results and other scored facts."""
