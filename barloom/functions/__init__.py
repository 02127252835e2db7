"""barloom.functions"""
